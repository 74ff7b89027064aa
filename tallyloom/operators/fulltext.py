"""Full-text matching on a positional inverted index: words, phrases, prefixes, nearness, and their combinations.

The index is a folder of two tables. `postings` has a row for each term of each document, with the term's positions;
it is partitioned by a hash of the term into SHARDS folders and sorted by term inside each file, so a word's query
reads one folder and, by the files' statistics, the parts with that word; a prefix is a range of terms. A shard's rows
are dealt over tasks by document when they are written, since a common word has a row for each document: SALT tasks, or
more, so that a task gets about TASK_WORDS however large the load is.
`sizes` has the number of documents and of words of each load. Loads are appended; documents aren't read by queries.

A query is made of `word`, `prefix`, `phrase` (of which the last word may be a prefix) and `near`, combined by `both`,
`either` and `without`. All postings that it names are read in one scan, and meet once, by document; phrases and
nearness are arithmetic on positions. Ranks follow the usual formula of weighted term frequencies.

Terms are runs of letters and digits, in lower case, without accents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import scoring as S

SHARDS, SALT = 16, 4
#: Words of a shard's load for each task that sorts and writes them, about; words that a task inverts at once (a longer text is handled whole).
TASK_WORDS, SLICE_WORDS = 1 << 20, 1 << 18


@dataclass(frozen=True)
class Leaf:
    """Words in a row, of which the last may be a prefix; or, with a distance, two words that near each other."""

    words: tuple[str, ...]
    open_end: bool = False
    distance: int | None = None


@dataclass(frozen=True)
class Pair:
    kind: str
    a: Leaf | Pair
    b: Leaf | Pair


def _accents() -> tuple[str, str]:
    """Latin letters with accents, and the letters without."""
    known = [(chr(i), unicodedata.normalize("NFD", chr(i))[0]) for i in range(0xC0, 0x250)]
    known = [(c, base) for c, base in known if c != base]
    return "".join(c for c, _ in known), "".join(b for _, b in known)


def terms(text: Column) -> Column:
    low = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[̀-ͯ]", "")
    return F.regexp_extract_all(F.translate(low, *_accents()), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _plain(word: str) -> str:
    bare = "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))
    if not bare or not all(c.isalnum() for c in bare):
        raise ValueError(f"not one word: {word!r}")
    return bare


def word(x: str) -> Leaf:
    return Leaf((_plain(x),))


def prefix(x: str) -> Leaf:
    return Leaf((_plain(x),), open_end=True)


def phrase(x: str) -> Leaf:
    """Words in a row; a star at the end makes the last one a prefix."""
    return Leaf(tuple(_plain(w) for w in x.rstrip("*").split()), open_end=x.endswith("*"))


def near(a: str, b: str, distance: int = 10) -> Leaf:
    """Two words with at most so many others between them."""
    return Leaf((_plain(a), _plain(b)), distance=distance)


def both(a, b) -> Pair:
    return Pair("both", a, b)


def either(a, b) -> Pair:
    return Pair("either", a, b)


def without(a, b) -> Pair:
    """What a matches and b doesn't."""
    return Pair("without", a, b)


def leaves(query: Leaf | Pair) -> Iterator[Leaf]:
    if isinstance(query, Leaf):
        yield query
    else:
        yield from leaves(query.a)
        yield from leaves(query.b)


def inverted(rows: DataFrame) -> DataFrame:
    """doc, term, positions of rows (doc, words); within each slice of a batch, nothing is shuffled."""

    def slices(batch):
        ends = np.cumsum(pc.list_value_length(batch.column("words")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_WORDS, side="right")))
            yield batch.slice(at, to - at)
            at = to

    def run(batches):
        for batch in (part for b in batches for part in slices(b)):
            lists = batch.column("words")
            if not (n := len(lists.flatten())):
                continue
            coded = pc.dictionary_encode(lists.flatten())
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            at = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
            code = coded.indices.to_numpy()
            order = np.lexsort((at, code, row))
            row, code, at = row[order], code[order], at[order]
            first = np.ones(n, bool)
            first[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
            starts = np.flatnonzero(first)
            positions = pa.ListArray.from_arrays(np.append(starts, n).astype(np.int32), pa.array(at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(row[starts])), coded.dictionary.take(pa.array(code[starts])), positions], names=["doc", "term", "positions"])

    return rows.mapInArrow(run, "doc long, term string, positions array<int>")


class Index:
    def __init__(self, spark: SparkSession, path: str, shards: int = SHARDS):
        self.spark, self.path, self.shards = spark, path, shards

    def add(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
        """Appends documents (their keys must be new; null keys aren't indexed)."""
        rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), terms(F.col(text)).alias("words"))
        seen = Observation()
        lengths = rows.select("doc", F.size("words").cast("long").alias("words"))
        lengths.observe(seen, F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).write.mode("append").parquet(f"{self.path}/lengths")
        n = seen.get
        self.spark.range(1).select(F.lit(n["docs"]).cast("long").alias("docs"), F.lit(n["words"]).cast("long").alias("words")).write.mode("append").parquet(f"{self.path}/sizes")
        salt = max(SALT, -(-n["words"] // (self.shards * TASK_WORDS)))
        postings = inverted(rows).withColumns({"shard": self.shard(F.col("term")), "salt": F.pmod(F.xxhash64("doc"), F.lit(salt))})
        dealt = postings.repartition(self.shards * salt, "shard", "salt").drop("salt").sortWithinPartitions("shard", "term", "doc")
        dealt.write.mode("append").partitionBy("shard").parquet(f"{self.path}/postings")
        return self

    def shard(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.shards)).cast("int")

    def postings(self) -> DataFrame:
        return self.spark.read.schema("doc long, term string, positions array<int>, shard int").parquet(f"{self.path}/postings")

    def _read(self, query: Leaf | Pair) -> DataFrame:
        """The postings that a query names. Shards are constants here, so that only their folders are listed."""
        exact = {w for x in leaves(query) for w in (x.words[:-1] if x.open_end else x.words)}
        begins = {x.words[-1] for x in leaves(query) if x.open_end}
        by_word = []
        if exact:
            asked = self.spark.range(1).select(F.array(*[self.shard(F.lit(w)) for w in sorted(exact)]).alias("s")).first()["s"]
            by_word.append(F.col("shard").isin(*{*asked}) & F.col("term").isin(*sorted(exact)))
        # a prefix is a range of terms: from itself to before the next string of its length
        by_word += [(F.col("term") >= b) & (F.col("term") < b[:-1] + chr(ord(b[-1]) + 1)) & F.col("term").startswith(b) for b in sorted(begins)]
        return self.postings().where(reduce(or_, by_word))

    def _hits(self, query: Leaf | Pair) -> DataFrame:
        """doc, h0, h1, ...: in how many places each leaf stands in a document that one of them stands in."""
        own = list(leaves(query))
        rows = self._read(query)
        gathered = lambda held: F.array_distinct(F.flatten(F.collect_list(F.when(held, F.col("positions")))))
        at = lambda w: gathered(F.col("term") == w)
        from_ = lambda w: gathered(F.col("term").startswith(w))
        names = {}
        for x in own:
            for i, w in enumerate(x.words):
                last = x.open_end and i == len(x.words) - 1
                names.setdefault((w, last), (from_ if last else at)(w))
        columns = {k: f"p{i}" for i, k in enumerate(names)}
        rows = rows.groupBy("doc").agg(*[names[k].alias(c) for k, c in columns.items()])

        def places(x: Leaf) -> Column:
            found = [F.col(columns[w, x.open_end and i == len(x.words) - 1]) for i, w in enumerate(x.words)]
            if x.distance is not None:
                reach = x.distance + 1
                return F.array_intersect(F.flatten(F.transform(found[0], lambda p: F.concat(F.sequence(p - reach, p - 1), F.sequence(p + 1, p + reach)))), found[1])
            start = lambda f, i: F.transform(f, lambda p: p - i)
            return reduce(F.array_intersect, [start(f, i) for i, f in enumerate(found)])

        return rows.select("doc", *[F.size(places(x)).cast("long").alias(f"h{i}") for i, x in enumerate(own)])

    def match(self, query: Leaf | Pair) -> DataFrame:
        """doc of the documents that a query matches."""
        return self._hits(query).where(_holds(query)).select("doc")

    def ranked(self, query: Leaf | Pair, among: DataFrame | None = None, top: int = 20) -> DataFrame:
        """doc, score: the best matches, by the sum of the leaves' weighted frequencies (those that are only excluded count for nothing). among: a table with doc, of which only these count."""
        own = list(leaves(query))
        hits = self._hits(query)
        total = self.spark.read.parquet(f"{self.path}/sizes").agg(F.sum("docs").alias("n"), (F.sum("words") / F.sum("docs")).alias("mean"))
        df = hits.agg(*[F.count_if(F.col(f"h{i}") > 0).alias(f"df{i}") for i in range(len(own))])
        found = hits.where(_holds(query))
        if among is not None:
            found = found.join(among.select("doc"), "doc", "left_semi")
        found = found.join(self.spark.read.parquet(f"{self.path}/lengths"), "doc").join(F.broadcast(total)).join(F.broadcast(df))  # one row each
        wanted = [i for i, positive in enumerate(_positive(query)) if positive]
        score = sum((S.bm25_part(F.col(f"h{i}"), F.col("words"), F.col("mean"), F.col("n"), F.col(f"df{i}")) for i in wanted), F.lit(0.0))
        return found.select("doc", score.alias("score")).orderBy(F.desc(F.round("score", 9)), "doc").limit(top)


def _holds(query: Leaf | Pair) -> Column:
    number = iter(range(1 << 30))

    def of(q) -> Column:
        if isinstance(q, Leaf):
            return F.col(f"h{next(number)}") > 0
        a, b = of(q.a), of(q.b)
        return a & b if q.kind == "both" else a | b if q.kind == "either" else a & ~b

    return of(query)


def _positive(query: Leaf | Pair, positive: bool = True) -> Iterator[bool]:
    """For each leaf, whether it is asked for."""
    if isinstance(query, Leaf):
        yield positive
    else:
        yield from _positive(query.a, positive)
        yield from _positive(query.b, positive and query.kind != "without")
