"""Names inside longer keys: a join by containment through shared k-grams, each pair of candidates verified.

A key that contains a name has each k-gram of the name. Each name is looked up by one of its k-grams alone, the one that
fewest keys have, so a key meets only the names whose rarest gram it holds; names shorter than K are looked up by
all of themselves. Grams that many keys have are dealt over SALT groups. A suffix needs no grams but the last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a gram; groups that the keys of a gram are dealt over.
K, SALT = 5, 8


def grams(x: Column, k: int) -> Column:
    """Distinct runs of k characters, overlapping."""
    return F.array_distinct(F.regexp_extract_all(x, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)))


def sizes(names: DataFrame) -> Column:
    """One row for each gram size that a name has (at most K values reach the driver)."""
    return F.explode(F.lit(sorted(r["k"] for r in names.select("k").distinct().collect())).cast("array<int>"))


def contained(names: DataFrame, keys: DataFrame, k: int = K, salt: int = SALT) -> DataFrame:
    """name, key for each distinct name that isn't empty and each distinct key that contains it. names: name; keys: key."""
    names = names.select("name").where("name != ''").distinct().withColumn("k", F.least(F.length("name"), F.lit(k)))
    by_size = lambda x: F.coalesce(*[F.when(F.col("k") == i, grams(x, i)) for i in range(1, k + 1)])
    own = names.select("name", "k", F.explode(by_size(F.col("name"))).alias("gram"))
    held = keys.select("key").where("key != ''").distinct()
    held = held.select("key", sizes(names).alias("k")).select("key", "k", F.explode(by_size(F.col("key"))).alias("gram"))
    asked = own.select("k", "gram").distinct()
    held = held.join(asked, ["k", "gram"], "left_semi")
    often = held.groupBy("k", "gram").agg(F.count("*").alias("n"))
    rarest = own.join(often, ["k", "gram"], "left").groupBy("name", "k").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    copies = rarest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    dealt = held.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salt)).cast("int"))
    return dealt.join(copies, ["k", "gram", "salt"]).where(F.col("key").contains(F.col("name"))).select("name", "key")


def as_suffix(names: DataFrame, keys: DataFrame, k: int = K) -> DataFrame:
    """name, key for each distinct name that isn't empty and each distinct key that ends with it."""
    names = names.select("name").where("name != ''").distinct().withColumn("k", F.least(F.length("name"), F.lit(k)))
    names = names.withColumn("end", F.expr("right(name, k)"))
    held = keys.select("key").distinct().select("key", sizes(names).alias("k")).where("length(key) >= k").withColumn("end", F.expr("right(key, k)"))
    return held.join(names, ["k", "end"]).where(F.col("key").endswith(F.col("name"))).select("name", "key")


def first_weights(files: DataFrame, songs: DataFrame, variant: str = "-analysis", otherwise: float = 1.0) -> DataFrame:
    """file, weight: of the first song (by place) whose key contains the file's name or its variant. files: file; songs: key, place, weight."""
    stem = F.regexp_replace("file", r"\.md$", "")
    both = files.select("file").distinct().select("file", F.explode(F.array("file", F.concat(stem, F.lit(f"{variant}.md")))).alias("name"))
    pairs = contained(both, songs).join(both, "name").join(songs, "key")
    first = pairs.groupBy("file").agg(F.min_by("weight", F.struct("place", "key")).alias("weight"))
    return files.select("file").distinct().join(first, "file", "left").select("file", F.coalesce("weight", F.lit(otherwise)).alias("weight"))
