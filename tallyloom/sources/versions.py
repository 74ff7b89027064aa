"""Versioned tables in a folder: readers see the old or the new whole, and an older one can be pointed to again.

A writer puts each version into a folder of its own, with a manifest of checksums beside it, and then swaps a small
pointer file by one atomic rename. A writer that dies before the swap leaves folders that nobody reads. The pointer
lists the versions in order, the current one last, so that going back is a swap, too. One writer at a time is assumed
for each folder; readers may be many.

On this rest: state files that others read while they are rewritten (`publish`, `current`), migrations that are verified
and undone (`migrate`, `verified`, `rollback`), results kept until they expire or their source changes (`memo`), and
snapshots of listings, so that only changed files are read (`changed_files`).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_pointer.json"
#: Paths that are read at once.
PATHS = 5000


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file_system(self, path: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return jvm, where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def log(self) -> list[dict]:
        """The entries of the pointer: name, and what the writer noted; the last one is current."""
        _, where, files = self._file_system(f"{self.path}/{POINTER}")
        if not files.exists(where):
            return []
        stream = files.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _point(self, entries: list[dict]) -> None:
        """One rename that replaces the pointer."""
        jvm, staged, files = self._file_system(f"{self.path}/_staged-{uuid.uuid4().hex}")
        stream = files.create(staged, True)
        try:
            stream.write(bytearray(json.dumps(entries).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(staged, jvm.org.apache.hadoop.fs.Path(f"{self.path}/{POINTER}"), options)

    def stage(self, rows: DataFrame) -> str:
        """Writes rows as a version that nobody reads yet, and gives its name."""
        name = f"v-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    def commit(self, name: str, **notes) -> None:
        self._point([*self.log(), {"name": name, **notes}])

    def publish(self, rows: DataFrame, **notes) -> DataFrame:
        """Replaces the table; rows may be read from the current version."""
        self.commit(self.stage(rows), **notes)
        return self.current()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def current(self) -> DataFrame | None:
        """The current version, or None before the first. A reader keeps what it has begun to read."""
        entries = self.log()
        return self.read(entries[-1]["name"]) if entries else None

    def rollback(self) -> DataFrame | None:
        """Points to the version before the current one (to none before the first)."""
        self._point(self.log()[:-1])
        return self.current()

    def clear(self, keep: int = 2) -> int:
        """Removes the folders of all but the last versions; those that a dead writer left go, too."""
        entries = self.log()[-keep:]
        self._point(entries)
        names = {e["name"] for e in entries} | {f"{e['name']}-manifest" for e in entries} | {POINTER}
        _, where, files = self._file_system(self.path)
        old = [s.getPath() for s in files.listStatus(where) if s.getPath().getName().lstrip(".").removesuffix(".crc") not in names]
        for p in old:
            files.delete(p, True)
        return len(old)


def manifest(rows: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key, bytes, checksum of each file."""
    return rows.select(key, F.octet_length(text).cast("long").alias("bytes"), F.sha2(text, 256).alias("checksum"))


def differing(a: DataFrame, b: DataFrame, key: str = "path") -> DataFrame:
    """key, problem: what one manifest has and the other hasn't, or has otherwise."""
    two = a.select(key, F.struct("bytes", "checksum").alias("a")).join(b.select(key, F.struct("bytes", "checksum").alias("b")), key, "full_outer")
    problem = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "not expected").when(F.col("a") != F.col("b"), "different")
    return two.select(key, problem.alias("problem")).where("problem IS NOT NULL")


def migrate(target: Versions, files: DataFrame, change: Callable[[DataFrame], DataFrame] = lambda rows: rows, key: str = "path", text: str = "text") -> DataFrame:
    """Copies files in two phases, and gives what went wrong (key, problem): nothing, or no version was committed.

    First the copies and the manifest of the originals are staged; then the copies are read again and held against
    the manifest; only if all are there and equal does the pointer move. change makes the copies, for tests.
    """
    name = target.stage(change(files))
    expected = f"{target.path}/{name}-manifest"
    manifest(files, key, text).write.parquet(expected)
    wrong = verified(target, name, key, text)
    if wrong.isEmpty():
        target.commit(name)
    return wrong


def verified(target: Versions, name: str | None = None, key: str = "path", text: str = "text") -> DataFrame:
    """key, problem of a version (the current one, by default), held against its manifest."""
    name = name or target.log()[-1]["name"]
    return differing(target.read(f"{name}-manifest"), manifest(target.read(name), key, text), key)


def memo(kept: Versions, source: str, make: Callable[[], DataFrame], seconds: float, now: float | None = None) -> DataFrame:
    """The kept result, or a new one if there is none, it is older than so many seconds, or its source has another version."""
    now = time.time() if now is None else now
    entries = kept.log()
    if entries and entries[-1].get("source") == source and now - entries[-1]["made"] < seconds:
        return kept.current()
    return kept.publish(make(), source=source, made=now)


def listing(spark: SparkSession, *paths: str, glob: str = "*") -> DataFrame:
    """path, bytes, changed of all files below the paths; none is read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(list(paths))
    return rows.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))


def version_of(spark: SparkSession, *paths: str, glob: str = "*") -> str:
    """A source's version: how many files it has, and a hash of their names, sizes and times; whatever their order."""
    got = listing(spark, *paths, glob=glob).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("path", "bytes", "changed")).alias("h")).first()
    return f"{got['n']}-{(got['h'] or 0) & (1 << 64) - 1:016x}"


def difference(old: DataFrame, new: DataFrame, key: str = "path", *marks: str) -> DataFrame:
    """key, state: added, removed or changed, of two listings; marks are the columns whose change counts."""
    values: Callable[[], Column] = lambda: F.struct(*(marks or ("bytes", "changed")))
    two = old.select(key, values().alias("a")).join(new.select(key, values().alias("b")), key, "full_outer")
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return two.select(key, state.alias("state")).where("state IS NOT NULL")


def changed_files(snapshots: Versions, *paths: str, glob: str = "*.md") -> Iterator[DataFrame]:
    """Reads the files that were added or changed since the last snapshot, in tables (path, text) of at most PATHS files, and no other file.

    A file counts by its size and time, and then by its text: one that was written again with the same text isn't given.
    The new snapshot (path, bytes, changed, checksum) is published when the caller has taken all tables, so files that
    a caller which died hasn't seen come again. Removed files only leave the snapshot.
    """
    spark = snapshots.spark
    now = listing(spark, *paths, glob=glob)
    before = snapshots.current()
    if before is None:
        before = now.limit(0).withColumn("checksum", F.lit(""))
    name = snapshots.stage(now)  # the listing, once; what changes meanwhile comes next time
    now = snapshots.read(name)
    todo = difference(before, now).where("state <> 'removed'").select("path").orderBy("path")
    checksums = before.select("path", "checksum").join(now.join(todo, "path", "left_anti"), "path").select("path", "bytes", "changed", "checksum")
    parts = []
    block: list[str] = []

    def taken(block: list[str]) -> DataFrame:
        rows = spark.read.format("binaryFile").load(block).select("path", F.decode("content", "UTF-8").alias("text"))
        part = snapshots.stage(rows.withColumn("checksum", F.sha2("text", 256)))
        parts.append(part)
        known = before.select(F.col("path"), F.col("checksum").alias("before"))
        return snapshots.read(part).join(known, "path", "left").where(F.col("before").isNull() | (F.col("before") != F.col("checksum"))).select("path", "text")

    for row in todo.toLocalIterator():  # paths, in blocks
        block.append(row["path"])
        if len(block) == PATHS:
            yield taken(block)
            block = []
    if block:
        yield taken(block)
    for part in parts:
        checksums = checksums.unionByName(now.join(snapshots.read(part).select("path", "checksum"), "path").select("path", "bytes", "changed", "checksum"))
    snapshots.publish(checksums)
