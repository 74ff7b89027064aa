"""Ranked lexical search: document-sharded postings with precomputed integer impacts, searched term at a time.

The index is a written table. Each row is a segment: a run of documents of about SEGMENT_BYTES of text, as compressed
sparse rows (sorted term hashes, offsets, places of documents, impacts). An impact is what a term adds to a document's
score before the term's weight; it is an integer and depends on the term's count, the document's size and the corpus'
sizes only, so it is made once, when the index is. The texts are read twice for it (sizes, postings), never for a search.

Queries come in blocks of at most about BLOCK_TERMS terms. Each task takes its segments one after the other: for every
query of the block it adds weight x impact of each term into a dense array over the segment's documents, takes the best
by a partition that keeps all ties, and merges them with the best of its segments so far. The tasks' best are merged in
two steps, first in SALT groups a query, so that no task gets all of a query.

Terms are runs of digits, letters A-Z (lower-cased) and all characters outside ASCII; they are identified by 64-bit
hashes, so results are exact up to hash collisions. Scores are 64-bit integers.

Defined results: a null or empty text, of a document or a query, has no terms, and neither finds nor is found; rows that
repeat are documents (or queries) of their own; equal scores go by ascending doc_id, a null doc_id last; empty tables
give no rows; a very long text is a segment of its own, handled whole in memory of about 60 times its bytes; other
columns aren't read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SEGMENT_BYTES = 2 << 20
#: Terms of a block of queries, about; bytes of a row group of the index (which bounds what a task reads at once); groups that merge a query's best first.
BLOCK_TERMS, ROW_GROUP, SALT = 1 << 18, 16 << 20, 8
TOP = 10
SEGMENT = "docs array<bigint>, terms array<bigint>, offsets array<int>, places array<int>, impacts array<int>"

_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"list_transform(regexp_extract_all(coalesce(text, ''), '{_CLASS}'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t))::BIGINT AS l FROM d),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS w FROM benchmark),
p AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(t) AS w FROM d) WHERE w IN (SELECT w FROM q) GROUP BY r, w),
f AS (SELECT w, floor(1000 * ln((2 * any_value(s.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY w),
x AS (
  SELECT item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(t) * s.n) // s.l))))::BIGINT AS score
  FROM q JOIN p USING (w) JOIN f USING (w) JOIN d USING (r), s GROUP BY item_id, r
),
o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= {TOP}
"""


def term_spans(text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Lower-cased bytes, starts and ends of the terms, their documents, and the number of documents."""
    data, offs = C.utf8(text)
    data = C.LOWER[data]
    return (data, *C.spans(data, offs, C.ALNUM), len(offs) - 1)


def sizes(docs: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and how many terms all have together."""

    def fold(batches):
        n = l = 0
        for batch in batches:
            for part in C.slices(batch):
                _, starts, _, doc, _ = term_spans(part.column("text"))
                n, l = n + len(np.unique(doc)), l + len(starts)
        yield pa.RecordBatch.from_pydict({"n": [n], "l": [l]}, schema=pa.schema([("n", pa.int64()), ("l", pa.int64())]))

    got = docs.select("text").mapInArrow(C.released(fold), "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return got["n"] or 0, got["l"] or 0


def inverted(h: np.ndarray, doc: np.ndarray, n_docs: int, n: int, l: int):
    """terms, offsets, places, impacts of terms h in documents doc; n and l are the corpus' sizes."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new_term = np.ones(len(h), bool)
    new_term[1:] = h[1:] != h[:-1]
    new = new_term.copy()
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(h)))
    m = 10 + (90 * np.bincount(doc, minlength=n_docs) * n) // max(l, 1)
    places = doc[at]
    impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[places])
    starts = np.flatnonzero(new_term[at])
    return h[at[starts]], np.append(starts, len(at)), places, impacts


class Index:
    """segments: the written table; n, l: documents with a term, and terms, of the corpus."""

    def __init__(self, docs: DataFrame):
        """docs: doc_id, text."""
        C.bounded_batches(docs.sparkSession)
        self.n, self.l = n, l = sizes(docs)

        def build(batches):
            for batch in batches:
                for part in C.slices(batch, SEGMENT_BYTES):
                    data, starts, ends, doc, n_docs = term_spans(part.column("text"))
                    if len(starts):
                        terms, offsets, places, impacts = inverted(C.word_hashes(data, starts, ends), doc, n_docs, n, l)
                        columns = (part.column("doc_id"), C.signed(terms), offsets.astype(np.int32), places.astype(np.int32), impacts.astype(np.int32))
                        rows = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c if isinstance(c, pa.Array) else pa.array(c)) for c in columns]
                        yield pa.RecordBatch.from_arrays(rows, names=["docs", "terms", "offsets", "places", "impacts"])

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(C.released(build), SEGMENT)
        # by default Parquet's writer looks at its size after 100 rows first, and holds, as do all who read, 100 segments
        self.segments = C.written(rows, options={"parquet.block.size": str(ROW_GROUP)} | {f"parquet.page.size.row.check.{x}": "1" for x in ("min", "max")})

    def document_frequencies(self, terms: np.ndarray) -> np.ndarray:
        """In how many documents each of the sorted terms stands; a row for each of them reaches the driver."""
        spark = self.segments.sparkSession
        asked = spark.sparkContext.broadcast(terms)

        def fold(batches):
            df = np.zeros(len(asked.value), np.int64)
            for batch in batches:
                for own, offsets in zip(unsigned(batch.column("terms")), lists(batch.column("offsets")), strict=True):
                    there, at = found(own, asked.value)
                    df[there] += offsets[at + 1] - offsets[at]
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

        got = self.segments.select("terms", "offsets").mapInArrow(C.released(fold), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
        out = np.zeros(len(terms), np.int64)
        out[got["term"].to_numpy(np.int64)] = got["df"].to_numpy(np.int64)
        return out

    def block(self, numbers: list[int], item_ids: list, own: list[np.ndarray], kind: str, top: int) -> DataFrame:
        """query, item_id, doc_id, score: the tasks' best of queries, given by their numbers, ids and sorted terms."""
        terms = np.unique(np.concatenate([np.empty(0, np.uint64), *own]))
        df = self.document_frequencies(terms).tolist()
        weight = np.array([math.floor(1000 * math.log((2 * self.n + 2) / (2 * d + 1))) for d in df], np.int64)
        places = [np.searchsorted(terms, x) for x in own]  # of each query's terms among those of the block
        shared = self.segments.sparkSession.sparkContext.broadcast((terms, weight, places, numbers, item_ids))
        id_type = pa.from_numpy_dtype(np.int64) if kind == "bigint" else None

        def search(batches):
            terms, weight, places, numbers, item_ids = shared.value
            best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))] * len(places)
            for batch in batches:
                columns = (batch.column("docs"), unsigned(batch.column("terms")), *(lists(batch.column(c)) for c in ("offsets", "places", "impacts")))
                for docs, own, offsets, doc, impact in zip(*columns, strict=True):
                    no_id = docs.values.is_null().to_numpy(zero_copy_only=False)
                    ids = pc.fill_null(docs.values, (1 << 63) - 1).to_numpy()
                    there, at = found(own, terms)
                    lo, hi = np.zeros((2, len(terms)), np.int64)
                    lo[there], hi[there] = offsets[at], offsets[at + 1]
                    for q, mine in enumerate(places):
                        score = np.zeros(len(ids), np.int64)
                        for t in mine[hi[mine] > lo[mine]].tolist():
                            score[doc[lo[t] : hi[t]]] += weight[t] * impact[lo[t] : hi[t]]
                        some = leading(score, ids, top)
                        if len(some):
                            s, i, no = (np.concatenate(x) for x in zip(best[q], (score[some], ids[some], no_id[some]), strict=True))
                            some = leading(s, i, top)
                            best[q] = s[some], i[some], no[some]
            count = [len(s) for s, _, _ in best]
            of = np.repeat(np.arange(len(best)), count)
            s, i, no = (np.concatenate([np.empty(0, d), *x]) for d, x in zip((np.int64, np.int64, bool), zip(*best, strict=True), strict=True)) if best else (np.empty(0, np.int64),) * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(numbers, np.int64)[of]), pa.array([item_ids[q] for q in of.tolist()], id_type), pa.array(i, mask=no.astype(bool)), pa.array(s)], names=["query", "item_id", "doc_id", "score"]
            )

        return self.segments.mapInArrow(C.released(search), f"query long, item_id {kind}, doc_id long, score long")

    def search(self, items: DataFrame, top: int = TOP) -> DataFrame:
        """item_id, rank, doc_id, score: for each row of items (item_id, text) the top documents with a score above 0."""
        spark = items.sparkSession

        def terms_of(batches):
            for batch in batches:
                for part in C.slices(batch):
                    data, starts, ends, doc, n = term_spans(part.column("text"))
                    h = C.word_hashes(data, starts, ends)
                    edges = np.searchsorted(doc, np.arange(n + 1))
                    own = [C.signed(np.unique(h[a:b])) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(own, pa.list_(pa.int64()))], names=["item_id", "terms"])

        kind = items.select("item_id").schema[0].dataType.simpleString()
        rows = items.select("item_id", "text").mapInArrow(terms_of, f"item_id {kind}, terms array<bigint>")
        asked = C.written(rows.where("size(terms) > 0").withColumn("query", F.monotonically_increasing_id()))
        blocks = max(1, math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / BLOCK_TERMS))
        parts = []
        for b in range(blocks):
            got = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).toArrow()  # a block's terms
            own = [x.values.to_numpy().view(np.uint64) for x in got.column("terms")]
            part = self.block(got.column("query").to_pylist(), got.column("item_id").to_pylist(), own, kind, top)
            parts.append(C.written(part) if blocks > 1 else part)
        best = parts[0]
        for part in parts[1:]:
            best = best.unionByName(part)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for keys in (("query", "salt"), ("query",)):
            rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            best = best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT))).withColumn("rank", rank).where(F.col("rank") <= top)
        return best.select("item_id", "rank", "doc_id", "score")


def lists(column: pa.Array):
    return (x.values.to_numpy() for x in column)


def unsigned(column: pa.Array):
    return (x.view(np.uint64) for x in lists(column))


def found(own: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the asked terms are among a segment's own, and where; both are sorted."""
    at = np.searchsorted(own, asked)
    there = np.flatnonzero((at < len(own)) & (own[np.minimum(at, len(own) - 1)] == asked))
    return there, at[there]


def leading(score: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the top scores above 0, the highest first, equal ones by ascending id."""
    some = np.flatnonzero(score > 0)
    if len(some) > top:
        s = score[some]
        some = some[s >= s[np.argpartition(s, len(s) - top)[len(s) - top]]]  # with all ties of the last
    return some[np.lexsort((ids[some], -score[some]))][:top]


def op11_ranked_search(spark, sf_dir) -> DataFrame:
    return Index(C.table(spark, sf_dir, "documents")).search(C.table(spark, sf_dir, "benchmark"))
