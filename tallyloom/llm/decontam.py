"""Benchmark decontamination: a prefix-filtered set join of document passages with benchmark windows.

A window is WINDOW consecutive words of an item (or all words of a shorter item). Its shingles of SHINGLE words are
ordered by how often documents hold them, rarest first. A passage that equals the window holds all its shingles, so
the prefix that must match has length one: only the rarest shingle is looked up. Its place in the window gives the
passage's bounds (length and position: the passage must lie inside the document), and then the passage's words are
compared with the window's, as strings.

The windows, the counts of their shingles and the prefixes are tables, made by joins and groupings, whatever size the
benchmark has. Documents are read twice: to count the windows' shingles in them, and to send the places where a prefix
stands, with the words around. A map of fixed size tells a task which shingles to look at; what it lets through by
chance is dropped by the joins. Texts are not shuffled.

Defined results: null or empty text has no words; an item without words matches nothing; with no benchmark, nothing
is contaminated; an item is its item_id, so rows that repeat it, or a window that it holds twice, count once; a null
item_id counts as an item but has no name in items_sha256; repeated documents get equal results; a very long text is
handled whole, in memory of about 60 times its words; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW = 10
#: Bytes of text that a task handles at once.
SLICE = 1 << 20
SHINGLE = 3
#: Places whose words a task holds at once.
RUN = 4096


class Words:
    """The words of some texts: hash, document, bounds of each document, and where the bytes stand."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data = C.LOWER[data]
        self.starts, self.ends, self.doc = C.spans(self.data, offs, C.ALNUM)
        self.hash = C.word_hashes(self.data, self.starts, self.ends)
        self.bounds = np.searchsorted(self.doc, np.arange(len(offs)))

    def shingles(self, n: int) -> np.ndarray:
        """The key of each run of n words; those that run over a document's end are of no use."""
        return C.mix(C.grams(self.hash, n)[: len(self.hash) - n + 1] + np.uint64(n)) if len(self.hash) >= n else np.empty(0, np.uint64)

    def text(self, lo: int, hi: int) -> list[str]:
        raw = self.data
        return [raw[s:e].tobytes().decode() for s, e in zip(self.starts[lo:hi], self.ends[lo:hi], strict=True)]


def windows(benchmark: DataFrame) -> DataFrame:
    """Written: (item, window, n, shingles), once for each item and window; item is `i` and the item_id, or `n` for a null one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, SLICE):
                w = Words(*C.utf8(part.column("text")))
                keys = {n: C.signed(w.shingles(n)) for n in range(1, SHINGLE + 1)}
                rows: list[tuple] = []
                for item, lo, hi in zip(part.column("item").to_pylist(), w.bounds[:-1], w.bounds[1:], strict=True):
                    own, size = w.text(lo, hi), min(WINDOW, hi - lo)
                    n = min(SHINGLE, size)
                    for at in range(lo, hi - size + 1 if size else lo):
                        rows.append((item, " ".join(own[at - lo : at - lo + size]), size, keys[n][at : at + size - n + 1]))
                if rows:
                    columns = zip(*rows, strict=True)
                    types = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["item", "window", "n", "shingles"])

    item = F.coalesce(F.concat(F.lit("i"), F.col("item_id").cast("string")), F.lit("n"))
    rows = benchmark.select(item.alias("item"), "text").where("text IS NOT NULL").mapInArrow(C.released(cut), "item string, window string, n int, shingles array<long>")
    return C.written(rows.dropDuplicates(["item", "window"]))


def places(w: Words, words: np.ndarray, sizes: list[int]):
    """Shingle length, key and first word of each place where a document holds a shingle of the map."""
    for n in sizes:
        key = w.shingles(n)
        at = np.flatnonzero(C.in_bitmap(words, key) & (w.doc[: len(key)] == w.doc[n - 1 :])) if len(key) else np.empty(0, np.int64)
        yield n, key[at], at


def document_frequency(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """Written: (shingle, c), how often documents hold each of the shingles that they hold at all."""
    shared = docs.sparkSession.sparkContext.broadcast((C.bitmap(shingles, "shingle"), sizes))

    def count(batches):
        for batch in batches:
            for part in C.slices(batch, SLICE):
                w = Words(*C.utf8(part.column("text")))
                for _, key, _ in places(w, *shared.value):
                    key, c = np.unique(key, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(C.signed(key)), pa.array(c, pa.int64())], names=["shingle", "c"])

    got = docs.select("text").mapInArrow(C.released(count), "shingle long, c long").groupBy("shingle").agg(F.sum("c").alias("c"))
    return C.written(got.join(shingles, "shingle", "left_semi"))


def prefixes(docs: DataFrame, owned: DataFrame, sizes: list[int]) -> DataFrame:
    """Written: (shingle, at, window, n), for each window that may occur its rarest shingle and that one's place in it."""
    each = owned.dropDuplicates(["window"]).select("window", "n", F.posexplode("shingles").alias("at", "shingle"))
    df = document_frequency(docs, each.select("shingle").distinct(), sizes)
    counted = C.looked_up(each, df, "shingle", F.col("window"), "left")
    rarest = counted.groupBy("window", "n").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "shingle", "at")).alias("m"))
    return C.written(rarest.where("m.c > 0").select("m.shingle", "m.at", "window", "n"))


#: kind 0: a row of docs; kind 1: a place of a row where a prefix may stand, with the words from WINDOW - 1 before it to WINDOW - 1 after it.
PLACE = "kind byte, row long, n_words long, shingle long, place int, before int, words array<string>"


def scanned(rows: DataFrame, names: list[str], prefix: DataFrame, sizes: list[int]) -> DataFrame:
    """Written: columns names of rows, then PLACE."""
    shared = rows.sparkSession.sparkContext.broadcast((C.bitmap(prefix, "shingle"), sizes))
    schema = ", ".join([*(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names), PLACE])

    def scan(batches):
        task, turn = TaskContext.get().partitionId() << 36, 0
        for batch in batches:
            for part in C.slices(batch, SLICE):
                w = Words(*C.utf8(part.column("text")))
                n_rows = part.num_rows
                rows_at = C.signed(C.mix((task + turn + np.arange(n_rows)).astype(np.uint64)))  # unlike numbers, spread over a map's bits
                turn += n_rows
                own = [part.column(n) for n in names]
                types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.zeros(n_rows, np.int8)), pa.array(rows_at), pa.array(np.diff(w.bounds), pa.int64()), *(pa.nulls(n_rows, t) for t in types)], names=[*names, "kind", "row", "n_words", "shingle", "place", "before", "words"])
                for n, keys, all_at in places(w, *shared.value):
                    for i in range(0, len(all_at), RUN):
                        key, at = keys[i : i + RUN], all_at[i : i + RUN]
                        doc = w.doc[at]
                        lo, hi = np.maximum(at - WINDOW + 1, w.bounds[doc]), np.minimum(at + n + WINDOW - 1, w.bounds[doc + 1])
                        text = pa.array([w.text(a, b) for a, b in zip(lo, hi, strict=True)], pa.list_(pa.string()))
                        found = [pa.array(np.ones(len(at), np.int8)), pa.array(rows_at[doc]), pa.nulls(len(at), pa.int64()), pa.array(C.signed(key)), pa.array(at - w.bounds[doc], pa.int32()), pa.array(at - lo, pa.int32()), text]
                        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(at), c.type) for c in own), *found], names=[*names, "kind", "row", "n_words", "shingle", "place", "before", "words"])

    return C.written(rows.mapInArrow(C.released(scan), schema), partition_by="kind")


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str], DataFrame, DataFrame]:
    """For every row of docs: keep (under the names given back), row and n_words; written: (row, start, n, window) of each passage that equals a window; and (item, window)."""
    owned = windows(benchmark)
    sizes = sorted(r["k"] for r in owned.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().collect())  # at most SHINGLE rows
    prefix = prefixes(docs, owned, sizes)
    rows, names = C.numbered(docs, keep)
    found = scanned(rows, names, prefix, sizes)
    places = C.looked_up(found.where("kind = 1").select("row", "shingle", "place", "before", "words"), prefix, "shingle", F.struct("row", "place"))
    first = F.col("before") - F.col("at")  # of the passage, among the words sent
    inside = places.where((first >= 0) & (first + F.col("n") <= F.size("words")))
    same = inside.where(F.array_join(F.slice("words", F.greatest(first + 1, F.lit(1)), F.col("n")), " ") == F.col("window"))
    hits = C.written(same.select("row", (F.col("place") - F.col("at")).alias("start"), "n", "window").distinct())
    return found.where("kind = 0").select(*names, "row", "n_words"), names, hits, owned.select("item", "window")


def described(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """For every row of docs: keep (under the names given back), n_words, hits (places of the hit words, ascending) and items (codes of the items with occurring windows, see windows)."""
    rows, names, hits, owned = contamination(docs, benchmark, keep)
    spans = F.transform(F.collect_set(F.struct("start", "n")), lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))
    hit = hits.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(spans))).alias("hits"))
    item = C.looked_up(hits.select("row", "window").distinct(), owned, "window", F.col("row")).select("row", "item").distinct()
    item = item.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = rows.join(hit, "row", "left").join(item, "row", "left")
    none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
    return out.select(*names, "n_words", none("hits", "array<int>"), none("items", "array<string>")), names


def op6_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    found, names = described(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"), ["doc_id"])
    item_names = F.array_sort(F.transform(F.filter("items", lambda c: c.startswith("i")), lambda c: F.substring(c, 2, 1 << 30)))
    return found.select(
        F.col(names[0]).alias("doc_id"),
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(item_names, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def stage_decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark window occurs; rows are told apart by a number of their own."""
    C.bounded_batches(spark)
    rows, names, hits, _ = contamination(docs, C.table(spark, sf_dir, "benchmark"), docs.columns)
    return C.renamed(C.without(rows, hits.select("row").distinct(), "row"), names, docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, w[i:i + size - 1] AS win FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM (SELECT *, least(10, len(w)) AS size FROM b) WHERE size > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, w[i:i + size - 1] AS win FROM (SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) AS i FROM d, sizes)),
m AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""
