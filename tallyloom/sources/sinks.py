"""Writing tables: upserts, appends of what is new, rotation, buffers. Spark's committer makes each write all or nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upserted(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key of both; of equal ones the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in old.columns if c != key]
    pick = F.max_by(F.struct(*rest), F.struct(order, "_new"))
    return both.groupBy(key).agg(pick.alias("r")).select(key, "r.*").select(*old.columns)


def unseen(old: DataFrame, new: DataFrame, key: str, least_chars: int = 50, text: str = "text") -> DataFrame:
    """New rows whose key isn't there, of at least so many characters."""
    return new.where(F.length(F.trim(text)) >= least_chars).join(old.select(key).distinct(), key, "left_anti")


def counted_links(links: DataFrame, item: str, tag: str) -> tuple[DataFrame, DataFrame]:
    """Distinct links, and each tag's count, made anew from them."""
    own = links.select(item, tag).distinct()
    return own, own.groupBy(tag).agg(F.count("*").alias("n"))


def last_rows(rows: DataFrame, order: Column, n: int) -> DataFrame:
    """The n last rows: a rotated log. A limit finds them without sorting all."""
    return rows.orderBy(order.desc()).limit(n)


def buffered(old: DataFrame, new: DataFrame, key: str, order: str, most: int = 100) -> DataFrame:
    """A buffer of distinct entries, the first of equal ones, the oldest beyond `most` dropped."""
    both = old.unionByName(new)
    rest = [c for c in both.columns if c != key]
    first = both.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r")).select(key, "r.*").select(*both.columns)
    return first.orderBy(F.desc(order), key).limit(most)


def with_front_matter(rows: DataFrame, fields: tuple[str, ...], body: str = "body") -> DataFrame:
    """rows with text: a block of the fields that aren't null, then the body."""
    lines = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{f}: \""), F.regexp_replace(F.col(f).cast("string"), '"', "'"), F.lit('"'))) for f in fields]))
    return rows.withColumn("text", F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n"), F.col(body)))


def write_texts(rows: DataFrame, path: str, name: str = "name", text: str = "text", partition: str | None = None) -> None:
    """Texts with their names, as JSON lines that can be appended to; one folder for each partition value."""
    writer = rows.select(name, text, *([partition] if partition else [])).write.mode("append")
    (writer.partitionBy(partition) if partition else writer).json(path)


def copied_right(original: DataFrame, copy: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """One row: files, copies, missing ones, and copies whose checksum differs."""
    a = original.select(key, F.md5(text).alias("a"))
    b = copy.select(key, F.md5(text).alias("b"))
    return a.join(b, key, "full_outer").agg(F.count("a").alias("originals"), F.count("b").alias("copies"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a") != F.col("b")).alias("different"))
