"""What texts say, by tables of patterns and keywords that the caller gives; and structured matching of words, phrases and prefixes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extracted(text: Column, pattern: str, group: int = 0) -> Column:
    """The distinct matches of a pattern, in the order in which they first stand."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))


def flags(text: Column, table: Mapping[str, str]) -> dict[str, Column]:
    """By name: whether the pattern matches."""
    return {name: F.coalesce(text.rlike(pattern), F.lit(False)) for name, pattern in table.items()}


def key_quotes(text: Column, patterns: Sequence[str], least: int = 50, most: int = 250, top: int = 15) -> Column:
    """Matches of the patterns, pattern by pattern, with white space collapsed, if their length lies between the bounds; the first ones."""
    found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in patterns]))
    tidy = F.transform(found, lambda q: F.regexp_replace(F.trim(q), "\\s+", " "))
    return F.slice(F.filter(tidy, lambda q: (F.length(q) > least) & (F.length(q) < most)), 1, top)


def categories(text: Column, keywords: Mapping[str, Sequence[str]], otherwise: str = "other") -> Column:
    """The categories of which a keyword stands in the text, in whatever case; the other one if there is none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.array_compact(F.array(*[F.when(reduce(or_, [low.contains(w) for w in words]), F.lit(name)) for name, words in keywords.items()]))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(otherwise)))


def holds(text: Column, words: Sequence[str] = (), any_of: Sequence[str] = (), none_of: Sequence[str] = ()) -> Column:
    """Whether a text holds all words, one of any_of, and none of none_of. An entry is a word, a phrase of several, or a word's beginning, with a star at its end; letters and digits count, in whatever case."""
    low = F.lower(F.coalesce(text, F.lit("")))

    def one(entry: str) -> Column:
        parts = [w for w in entry.lower().rstrip("*").split() if w]
        end = "" if entry.endswith("*") else "(?![a-z0-9])"
        return low.contains(parts[0]) & low.rlike("(?<![a-z0-9])" + "[^a-z0-9]+".join(parts) + end)

    conditions = [one(w) for w in words] + ([reduce(or_, [one(w) for w in any_of])] if any_of else []) + [~one(w) for w in none_of]
    return reduce(and_, conditions, F.lit(True))


def topics(index: DataFrame, terms: Sequence[str], top: int | None = 3) -> DataFrame:
    """topic, score: the topics whose names hold the most of the terms; all that hold one, in no order, without `top`. index: topic."""
    score = sum((F.lower("topic").contains(t.lower()).cast("long") for t in terms), F.lit(0).cast("long"))
    found = index.select("topic", score.alias("score")).where("score > 0")
    return found if top is None else found.orderBy(F.desc("score"), "topic").limit(top)


def confidence(rows: DataFrame, group: str, hit: Column, least_rows: int = 25, least_hits: int = 3) -> DataFrame:
    """By group: rows, hits, and what an answer must warn of: few articles, few matches."""
    out = rows.groupBy(group).agg(F.count("*").alias("articles"), F.count_if(hit).alias("hits"))
    warning = F.when(F.col("articles") < least_rows, F.when(F.col("hits") < least_hits, "small, low confidence").otherwise("small")).when(F.col("hits") < least_hits, "low confidence").otherwise("")
    return out.withColumn("warning", warning)


def audit(texts: DataFrame, tiers: Sequence[tuple[str, int]], otherwise: str) -> DataFrame:
    """By tier of length, and in total (tier null): texts, lines, average lines. tiers: name and the lines below which it holds, ascending."""
    lines = F.size(F.split("text", "\n")).cast("long")
    tier = F.coalesce(*[F.when(F.col("lines") < most, F.lit(name)) for name, most in tiers], F.lit(otherwise))
    rows = texts.where("text IS NOT NULL").select(lines.alias("lines")).withColumn("tier", tier)
    return rows.rollup("tier").agg(F.count("*").alias("texts"), F.sum("lines").alias("lines"), F.round(F.avg("lines"), 6).alias("mean_lines"))


def coerced(rows: DataFrame, defaults: Mapping[str, str], extras: Sequence[str]) -> DataFrame:
    """The columns of defaults as strings, nulls and blanks replaced; the extras that aren't null as one JSON value, null if none is left."""
    own = [F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(d)).alias(c) for c, d in defaults.items()]
    pairs = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in extras]), F.array(*[F.col(c).cast("string") for c in extras])), lambda k, v: v.isNotNull())
    return rows.select(*own, F.when(F.size(pairs) > 0, F.to_json(pairs)).alias("extras"))


def cooled(merges: DataFrame, days: Column, cooldown: int = 30) -> DataFrame:
    """merges (a, b, left: days of cooldown) after so many days: what is left, and whether the pair may merge again."""
    left = F.greatest(F.lit(0), F.least(F.col("left"), F.lit(cooldown)) - days).cast("long")
    return merges.select("a", "b", left.alias("left"), (left == 0).alias("free"))

