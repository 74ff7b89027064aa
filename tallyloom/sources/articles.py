"""Articles: Markdown files with a header, read as one row for each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

DEFAULTS = {"title": "Untitled", "author": "Unknown"}
KNOWN = ("title", "author", "source", "url", "date", "tags")


def read(spark: SparkSession, *paths: str, glob: str = "*.md", skip: tuple[str, ...] = ("INDEX.md", "README.md")) -> DataFrame:
    """path, text of the files below any of the paths."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(list(paths), wholetext=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.where(~F.substring_index("path", "/", -1).isin(*skip)) if skip else rows


def listing(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """path, bytes, changed of the files, without reading them."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return rows.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def source_key(path: Column) -> Column:
    """The folder before `articles`, else the file's own."""
    found = F.regexp_extract(path, "([^/]+)/articles/", 1)
    return F.when(found != "", found).otherwise(F.regexp_extract(path, "([^/]+)/[^/]+$", 1))


def front_matter(text: Column) -> Column:
    """A map of the `key: value` lines of a leading block; null where none is closed."""
    block = F.regexp_extract(text, "(?s)\\A---\\r?\\n(.*?)\\r?\\n---[ \\t]*(?:\\r?\\n|\\z)", 1)
    lines = F.filter(F.split(block, "\\r?\\n"), lambda x: x.rlike("^[A-Za-z_][\\w-]*\\s*:"))
    unquoted = lambda v: F.regexp_replace(F.trim(v), "^[\"']|[\"']$", "")
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), unquoted(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    # the last of equal keys counts
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.when(block != "", F.map_from_entries(last))


def header(text: Column) -> Column:
    """A map from a `# Title`, `**Author:** ...`, `---` header within fifteen lines; null without its end."""
    lines = F.slice(F.split(text, "\\r?\\n"), 1, 16)
    end = F.array_position(F.transform(lines, lambda x: F.trim(x)), "---")
    top = F.slice(lines, F.lit(1), F.greatest(end - 1, F.lit(0)).cast("int"))
    title = F.regexp_extract(F.array_join(top, "\n"), "(?m)^# (.+)$", 1)
    field = lambda name: F.trim(F.regexp_extract(F.array_join(top, "\n"), f"(?m)^\\*\\*{name}:\\*\\*(.*)$", 1))
    values = F.map_from_arrays(F.array(*[F.lit(k) for k in ("title", "author", "date", "url")]), F.array(title, field("Author"), field("Date"), field("URL")))
    return F.when((end > 0) & (title != ""), F.map_filter(values, lambda k, v: v != ""))


def parsed(files: DataFrame) -> DataFrame:
    """path, the known fields with their defaults, other fields as JSON, body, words, content_hash. Either form of header."""
    rows = files.withColumn("meta", F.coalesce(front_matter(F.col("text")), header(F.col("text")), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    body = stripped(F.when(front_matter(F.col("text")).isNotNull(), X.without_front_matter(F.col("text"))).when(header(F.col("text")).isNotNull(), F.regexp_replace("text", "(?s)\\A.*?\\n---[ \\t]*\\r?\\n", "")).otherwise(F.col("text")))
    field = lambda k: F.coalesce(F.nullif(F.try_element_at("meta", F.lit(k)), F.lit("")), F.lit(DEFAULTS.get(k)).cast("string"))
    tags = F.filter(F.split(F.regexp_replace(F.coalesce(F.try_element_at("meta", F.lit("tags")), F.lit("")), "[\\[\\]\"']", ""), "\\s*,\\s*"), lambda t: t != "")
    extras = F.map_filter("meta", lambda k, v: ~k.isin(*KNOWN))
    return rows.select("path", *[field(k).alias(k) for k in KNOWN if k != "tags"], tags.alias("tags"), F.when(F.size(extras) > 0, F.to_json(extras)).alias("extras"), body.alias("body"), X.word_count(body).alias("words"), F.md5(body).alias("content_hash"))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, "\\A\\s+|\\s+\\z", "")


def title_of(text: Column, path: Column) -> Column:
    """From the header, else the first heading, else the file's name."""
    meta = F.try_element_at(front_matter(text), F.lit("title"))
    heading = F.regexp_extract(F.array_join(F.slice(F.split(text, "\\n"), 1, 20), "\n"), "(?m)^# (.+)$", 1)
    name = F.initcap(F.translate(F.regexp_extract(path, "([^/]+)\\.[^.]+$", 1), "-_", "  "))
    return F.coalesce(F.nullif(meta, F.lit("")), F.nullif(heading, F.lit("")), name)


def sections(files: DataFrame) -> DataFrame:
    """path, section, level, heading, text, tokens: parts of each text from heading to heading; what stands before the first has level 0."""
    lines = F.split("text", "\n")
    part = F.struct(F.lit(0).alias("level"), F.lit("").alias("heading"), F.lit("").alias("text"))
    start = F.array(part)

    def add(acc: Column, line: Column) -> Column:
        level = F.length(F.regexp_extract(line, "^(#{1,4}) ", 1))
        last = F.element_at(acc, -1)
        more = F.struct(last["level"].alias("level"), last["heading"].alias("heading"), F.when(last["text"] == "", line).otherwise(F.concat(last["text"], F.lit("\n"), line)).alias("text"))
        new = F.struct(level.alias("level"), F.trim(F.regexp_replace(line, "^#{1,4} ", "")).alias("heading"), F.lit("").alias("text"))
        return F.when(level > 0, F.concat(acc, F.array(new))).otherwise(F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(more)))

    rows = files.select("path", F.posexplode(F.aggregate(lines, start, add)).alias("section", "s"))
    return rows.select("path", "section", "s.level", "s.heading", "s.text", X.tokens_estimate(F.col("s.text")).alias("tokens")).where("level > 0 OR trim(text) != ''")
