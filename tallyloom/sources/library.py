"""A library of articles as files: article texts with their headers, metadata and an index by source; what sessions did to files; skills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from . import articles as A


def article_files(rows: DataFrame) -> DataFrame:
    """source, name, words, text of each article, as `articles.parsed` reads it. rows: id, title, author, date, url, source, body."""
    known = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Unknown"))
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("Untitled"))
    name = F.concat(F.lpad(F.col("id").cast("string"), F.greatest(F.lit(3), F.length(F.col("id").cast("string"))), "0"), F.lit("-"), X.slug(title), F.lit(".md"))
    body = F.coalesce("body", F.lit(""))
    text = F.concat(F.lit("# "), title, F.lit("\n\n**Author:** "), known("author"), F.lit("\n**Date:** "), known("date"), F.lit("\n**URL:** "), F.coalesce("url", F.lit("")), F.lit("\n\n---\n\n"), body, F.lit("\n"))
    return rows.select("source", name.alias("name"), X.word_count(body).cast("long").alias("words"), text.alias("text"))


def index_lines(rows: DataFrame) -> DataFrame:
    """source, place, line: the index of each source, a line for each article by id. Lines, not one text, so that a source may have any number of articles."""
    place = F.row_number().over(Window.partitionBy("source").orderBy("id"))
    title = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("Untitled"))
    return rows.select("source", place.cast("long").alias("place"), F.concat(F.lit("- ["), title, F.lit("]("), F.coalesce("url", F.lit("")), F.lit(")")).alias("line"))


def metadata(rows: DataFrame) -> DataFrame:
    """By source: articles, those without a text, words, first and last date."""
    n = X.word_count(F.coalesce("body", F.lit("")))
    empty = F.trim(F.coalesce("body", F.lit(""))) == ""
    return rows.groupBy("source").agg(F.count("*").alias("articles"), F.count_if(empty).alias("empty"), F.sum(n).cast("long").alias("words"), F.min("date").alias("first"), F.max("date").alias("last"))


def save(rows: DataFrame, path: str) -> None:
    """Writes articles, index and metadata below a path, by source; each is replaced as a whole."""
    article_files(rows).write.mode("overwrite").partitionBy("source").json(f"{path}/articles")
    lines = index_lines(rows).repartition("source").sortWithinPartitions("source", "place")
    lines.write.mode("overwrite").partitionBy("source").json(f"{path}/index")
    metadata(rows).write.mode("overwrite").json(f"{path}/metadata")


def skills(files: DataFrame) -> DataFrame:
    """path, name, description, category of skill files: from the front matter, else the first paragraph that says when to use it. files: path, text."""
    meta = A.front_matter(F.col("text"))
    field = lambda k: F.nullif(F.try_element_at(meta, F.lit(k)), F.lit(""))
    paragraph = F.regexp_extract("text", r"(?s)(Use (?:when|this).+?)(?:\n\n|\n#|\z)", 1)
    name = F.regexp_extract("path", "([^/]+)/[^/]+$", 1)
    return files.select("path", name.alias("name"), F.coalesce(field("description"), F.regexp_replace(F.trim(paragraph), "\n", " ")).alias("description"), F.coalesce(field("category"), F.lit("")).alias("category"))


def session_files(blocks: DataFrame) -> DataFrame:
    """By session: tool calls, distinct tools, files written first and files only edited (sorted), failed results. blocks: path, kind, name, target, error, as `logs.blocks` gives them."""
    is_tool = F.col("kind") == "tool"
    by_file = blocks.where(is_tool & F.col("name").isin("Write", "Edit", "MultiEdit", "NotebookEdit") & F.col("target").isNotNull()).groupBy("path", "target").agg(F.max(F.col("name") == "Write").alias("written"))
    files = by_file.groupBy("path").agg(F.array_sort(F.collect_list(F.when(F.col("written"), F.col("target")))).alias("created"), F.array_sort(F.collect_list(F.when(~F.col("written"), F.col("target")))).alias("edited"))
    counted = blocks.groupBy("path").agg(F.count_if(is_tool).alias("calls"), F.countDistinct(F.when(is_tool, F.col("name"))).alias("tools"), F.count_if((F.col("kind") == "result") & F.col("error")).alias("errors"))
    none = F.array().cast("array<string>")
    return counted.join(files, "path", "left").select("path", "calls", "tools", "errors", F.coalesce("created", none).alias("created"), F.coalesce("edited", none).alias("edited"))


def canonical(rows: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """rows with canonical: the key that an alias stands for, in whatever case; the key itself where it is one; null where nothing knows it. aliases: alias, canonical; the first canonical key of an alias, by name, counts."""
    known = aliases.select(F.lower(F.trim("alias")).alias("_alias"), "canonical").unionByName(aliases.select(F.lower(F.trim("canonical")).alias("_alias"), "canonical"))
    once = known.groupBy("_alias").agg(F.min("canonical").alias("canonical"))
    return rows.withColumn("_alias", F.lower(F.trim(key))).join(once, "_alias", "left").drop("_alias")


def expanded(queries: DataFrame, synonyms: DataFrame, stem) -> DataFrame:
    """id, word, weight of each query's words: its own 1.0, their stems 0.7, the words of their synonyms 0.5; the first weight of a word counts. queries: id, text; synonyms: word, synonym; stem: a function on a column."""
    own = queries.select("id", F.explode(F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")), " "))).alias("word")).where("word != ''")
    stems = own.select("word").distinct().select("word", stem(F.col("word")).alias("stem")).where("stem != '' AND stem != word")
    other = synonyms.select(F.lower("word").alias("word"), F.explode(F.split(F.trim(F.lower("synonym")), r"\s+")).alias("other")).where("other != ''").distinct()
    layers = own.select("id", "word", F.lit(1.0).alias("weight"))
    layers = layers.unionByName(own.join(stems, "word").select("id", F.col("stem").alias("word"), F.lit(0.7).alias("weight")))
    layers = layers.unionByName(own.join(other, "word").select("id", F.col("other").alias("word"), F.lit(0.5).alias("weight")))
    return layers.groupBy("id", "word").agg(F.max("weight").alias("weight"))
