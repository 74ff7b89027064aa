"""Integrity checks and small parsers: signatures, numbers near words, task boards, references, packages, experiments."""

from __future__ import annotations

import ast
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def signature(text: Column, key: bytes) -> Column:
    """HMAC-SHA256 of a text, lowercase hex: two hashes with the padded key, in built-in functions."""
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(text, "UTF-8")), 256))), 256)


def numbers_near(text: Column, word: str, within: int = 20) -> Column:
    """Numbers that stand on the same line as the word and at most so many characters before it."""
    found = F.regexp_extract_all(text, F.lit(f"(?i)([0-9][0-9,]*)[^0-9\\n]{{0,{within}}}{word}"), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, ",", "").try_cast("long"))


def parses(code: str) -> bool:
    try:
        ast.parse(code)
    except (SyntaxError, ValueError):
        return False
    return True


@F.pandas_udf(T.BooleanType())
def is_python(code: pd.Series) -> pd.Series:
    """Whether a text is Python code; it is parsed, never run."""
    return code.map(parses, na_action="ignore")


#: Statuses of tasks in order of urgency, with the words that tell them.
STATUSES = (("BLOCKED", "blocked|waiting"), ("IN PROGRESS", "in progress|doing|wip"), ("NEXT", "next|todo|planned"), ("DONE", "done|shipped|complete"))


def tasks(boards: DataFrame, most: int = 10) -> DataFrame:
    """path, place, section, name, status of each board's most urgent tasks: `- **name** ...` lines with the heading above them.

    boards: path, text. The status is told by the line, else by the heading.
    """
    lines = boards.select("path", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    heading = F.nullif(F.regexp_extract("line", "^#{1,4}\\s+(.+)$", 1), F.lit(""))
    section = F.last(heading, ignorenulls=True).over(Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    rows = lines.withColumn("section", section).where(F.col("line").rlike("^\\s*[-*]\\s+\\*\\*"))
    told = lambda c: F.coalesce(*[F.when(F.lower(c).rlike(p), s) for s, p in STATUSES])
    rows = rows.select("path", "pos", "section", F.regexp_extract("line", "\\*\\*(.+?)\\*\\*", 1).alias("name"), F.coalesce(told(F.col("line")), told(F.col("section")), F.lit("NEXT")).alias("status"))
    rank = F.array_position(F.array(*[F.lit(s) for s, _ in STATUSES]), F.col("status"))
    place = F.row_number().over(Window.partitionBy("path").orderBy(rank, "pos"))
    return rows.withColumn("place", place).where(F.col("place") <= most).select("path", "place", "section", "name", "status")


def next_action(found: DataFrame) -> DataFrame:
    """path, name, status: the first task that isn't done."""
    return found.where("status != 'DONE'").groupBy("path").agg(F.min_by(F.struct("name", "status"), "place").alias("t")).select("path", "t.*")


def cross_references(text: Column) -> Column:
    """A map from an identifier to those that it refers to, from lines `X1 -> [Y1, Y2]` or `| X1 | Y1, Y2 |`."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("^\\|?\\s*[A-Z]+[0-9]+\\s*(->|→|\\|)"))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, "([A-Z]+[0-9]+)", 1).alias("k"), F.regexp_extract_all(F.regexp_replace(x, "^\\|?\\s*[A-Z]+[0-9]+", ""), F.lit("[A-Z]+[0-9]+"), F.lit(0)).alias("v")))
    first = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(first)


def title_kind(title: Column, kinds: Sequence[tuple[str, str]], otherwise: str = "other") -> tuple[Column, Column, Column]:
    """kind, artist and year of a title: the first pattern that fits; what stands before a dash; a year in it."""
    kind = F.coalesce(*[F.when(title.rlike(p), k) for k, p in kinds], F.lit(otherwise))
    artist = F.nullif(F.trim(F.regexp_extract(title, "^(.+?)\\s+[-–—]\\s+", 1)), F.lit(""))
    year = F.nullif(F.regexp_extract(title, "(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1), F.lit("")).try_cast("int")
    return kind, artist, year


def package(sections: Sequence[tuple[str, Column]], most: int, expendable: Sequence[str]) -> Column:
    """Sections joined; if they are longer than `most`, the expendable ones go, in their order, until they fit or none is left."""
    joined = lambda without: F.array_join(F.array(*[F.coalesce(c, F.lit("")) for n, c in sections if n not in without]), "\n\n")
    options = [joined(expendable[:i]) for i in range(len(expendable) + 1)]
    out = options[-1]
    for option in reversed(options[:-1]):
        out = F.when(F.length(option) <= most, option).otherwise(out)
    return out


def missing(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required keys that aren't present."""
    return required.select(key).distinct().join(present.select(key), key, "left_anti")


def advanced(experiments: DataFrame, changes: DataFrame) -> DataFrame:
    """Experiments (id, status, hypothesis, observations) after changes (id, status, observation, at), in order: archived ones stay."""
    own = changes.groupBy("id").agg(F.max_by("status", F.when(F.col("status").isNotNull(), F.col("at"))).alias("new"), F.transform(F.array_sort(F.collect_list(F.when(F.col("observation").isNotNull(), F.struct("at", "observation")))), lambda s: s["observation"]).alias("more"))
    rows = experiments.join(own, "id", "left")
    closed = F.col("status") == "archived"
    return rows.select(
        "id",
        F.when(closed, F.col("status")).otherwise(F.coalesce("new", "status")).alias("status"),
        "hypothesis",
        F.when(closed | F.col("more").isNull(), F.col("observations")).otherwise(F.concat("observations", "more")).alias("observations"),
    )


def watchlist(experiments: DataFrame) -> DataFrame:
    """Running experiments, those with the fewest observations first."""
    return experiments.where("status = 'running'").withColumn("n", F.size("observations")).orderBy("n", "id")
