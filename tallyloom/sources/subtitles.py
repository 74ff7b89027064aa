"""Subtitles: lines of speech from VTT and SRT files, in order, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def spoken(files: DataFrame) -> DataFrame:
    """path, pos, line: spoken lines without cue numbers, times, tags and notes in brackets; a repeated line stays at its first place.

    files: path, text; either format.
    """
    rows = files.select("path", F.posexplode(F.split("text", "\\r?\\n")).alias("pos", "raw"))
    line = F.trim(F.regexp_replace("raw", "<[^>]+>", ""))
    rows = rows.select("path", "pos", line.alias("line")).where(
        (F.col("line") != "")
        & ~F.col("line").rlike("^(WEBVTT|NOTE|STYLE|Kind:|Language:)")
        & ~F.col("line").rlike("^[0-9]+$")
        & ~F.col("line").contains("-->")
        & ~F.col("line").rlike("^\\[[^\\]]*\\]$")
    )
    return rows.groupBy("path", "line").agg(F.min("pos").alias("pos")).select("path", "pos", "line")


def transcript(files: DataFrame, per_paragraph: int = 4) -> DataFrame:
    """path, text: the lines joined, split into sentences and grouped into paragraphs."""
    joined = spoken(files).groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), " ").alias("all"))
    rows = joined.withColumn("s", X.sentences(F.col("all")))
    n = F.greatest(F.ceil(F.size("s") / per_paragraph).cast("int"), F.lit(1))
    groups = F.transform(F.sequence(F.lit(0), n - 1), lambda g: F.array_join(F.slice("s", g * per_paragraph + 1, F.lit(per_paragraph)), " "))
    return rows.select("path", F.array_join(groups, "\n\n").alias("text"))
