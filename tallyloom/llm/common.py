"""What the operators share: the shared folder, tables written there, and texts as numpy arrays inside Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task handles at once (a longer single text is handled whole).
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch that Spark hands to a Python step, beside its last row.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a word: all but white space (0x20, 0x09-0x0D).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of a word, after lower-casing A-Z: digits, a-z and all of a character outside ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's batches hold BATCH_BYTES at most, unless its setting is lower already. By default they hold 64 MB, which executors keep several times outside their heap, beside the Python workers' copies."""
    digits, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)i?b?\s*", spark.conf.get(BATCH_SETTING).lower()).groups()
    if not 0 < int(digits) << 10 * " kmgtp".index(unit or " ") <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, as in tests, a temporary one, on a local master only."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not (sc.master or "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tallyloom-")
        sc.setCheckpointDir(found)
    return found


def written(df: DataFrame, partition_by: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there and lost executors cost nothing that is written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a map of keys; rows and bytes of a table that is broadcast, at most; groups that the rows of one key are dealt over.
BITS, BROADCAST_ROWS, BROADCAST_BYTES, SALT = 1 << 24, 200_000, 32 << 20, 16


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A map of BITS bits, whatever keys holds: for each value of a long column, the bit of its last digits is set."""
    low = F.col(column).bitwiseAND(F.lit(BITS - 1))
    bit = F.expr(f"shiftleft(1L, cast({column} & 63L AS int))")
    rows = keys.groupBy(F.shiftright(low, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    words = np.zeros(BITS // 64, np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return words


def in_bitmap(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    low = h & np.uint64(BITS - 1)
    return (words[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


def small(table: DataFrame) -> bool:
    """Whether a written table may be broadcast."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(0).cast("long"))
    got = table.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    return got["n"] <= BROADCAST_ROWS and (got["bytes"] or 0) <= BROADCAST_BYTES


def looked_up(rows: DataFrame, table: DataFrame, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """rows joined with a written table that has few rows for each key. A small table is broadcast; else the rows of each key are dealt over SALT groups by spread, and the table's rows are copied to each, so that no key's rows meet in one task."""
    if small(table):
        return rows.join(F.broadcast(table), key, how)
    copies = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int"))
    return dealt.join(copies, [key, "salt"], how).drop("salt")


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows whose key, a long that isn't null, isn't in gone, a written table of one column of that name.

    A map of BITS bits, whatever the tables hold, is broadcast and says of most rows that they stay; only the others are
    shuffled, to be looked up.
    """
    bit = f"shiftleft(1L, cast({key} & 63L AS int))"
    word = F.shiftright(F.col(key).bitwiseAND(F.lit(BITS - 1)), 6)
    words = gone.groupBy(word.alias("word of key")).agg(F.bit_or(F.expr(bit)).alias("bits of key"))
    marked = rows.withColumn("word of key", word).join(F.broadcast(words), "word of key", "left")
    marked = marked.withColumn("asked of key", F.coalesce(F.col("bits of key").bitwiseAND(F.expr(bit)) != 0, F.lit(False)))
    checked = marked.where("`asked of key`").join(gone, key, "left_anti")
    return marked.where("NOT `asked of key`").select(*rows.columns).unionByName(checked.select(*rows.columns))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def remainder(column: str, n: int):
    """crc32 of an id's decimal text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def released(run):
    """run, a function on an iterator of batches; memory that it has freed then goes back to the system, since the worker lives on beside others."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def give_back() -> None:
    """Memory that is free goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def numbered(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """Columns keep of docs under names that clash with nothing, and text."""
    names = [f"c{i}" for i in range(len(keep))]
    return docs.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keep, names, strict=True)], F.col("`text`").alias("text")), names


def renamed(rows: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    return rows.select(*[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)])


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and the offsets of each."""
    col = pc.fill_null(col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col, "").cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most limit bytes together, or one row."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    at = 0
    while at < len(ends):
        base = ends[at] - size[at]
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def spans(data: np.ndarray, offs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the words; word says which bytes belong to one."""
    inside = word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edge = offs[:-1][np.diff(offs) > 0]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[edge[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: A random value for each byte, and the base of the polynomial.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.full(64, BASE, np.uint64))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 2 * len(_powers)), BASE, np.uint64))
    return _powers


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, run: int = 1 << 16) -> np.ndarray:
    """A 64-bit hash of each word's bytes; a run of words at a time, so that memory is a small multiple of the text's."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), run):
        lo, size = starts[i : i + run], ends[i : i + run] - starts[i : i + run]
        first = np.cumsum(size) - size
        within = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
        letters = BYTE[data[np.repeat(lo, size) + within]]
        letters *= powers(int(size.max()))[within]
        out[i : i + run] = mix(np.add.reduceat(letters, first) + size.astype(np.uint64))
    return out


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n words, by its first word; the last n - 1 places hold nothing of use."""
    out = h.copy()
    for k in range(1, n):
        out[:-k] = mix(out[:-k] * BASE + h[k:])
    return out


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
