"""Document fingerprints by randomised edit embedding.

Every text takes the same random walk: at step j the embedding shows the current character, and a coin shared by all
texts, one for each (j mod PERIOD, character), says whether the walk moves on to the next character. Two texts that differ
by few edits fall back into step soon after each edit, so their edit distance shows as Hamming distance of the
embeddings. Positions are sampled consistently: a position has the level of the trailing zeros of its hash, and a text
of n characters keeps the positions of level log2(n / SAMPLES) and more, so any two texts share the coarser one's
positions, whatever their lengths. The fingerprint is the level and a hex digit for each kept position.

`search` looks similar texts up. Each band samples BAND neighbouring steps of the embedding, at a place chosen by hash
over the whole length of the text, which walks forwards and backwards: the places of a level are shared by all texts of
about one length, so an edit anywhere leaves most of the others as they were. Rows that share a band are candidates; the fingerprints' likeness and
then the edit distance itself verify them. A band value that more than HOT documents share is split by further steps of
the embedding; texts that are equal are one candidate, whatever their number.

Defined results: a null text is an empty one, with an empty fingerprint; two empty texts have likeness 1, an empty and
another one 0; equal texts have equal fingerprints. The next document follows in the order (doc_id, text), a null
doc_id first; a single row's next document is itself; a very long text is handled whole, in memory of about 30 times its
characters. Other columns are not read.
"""

from __future__ import annotations

from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

PERIOD = 4096
KINDS = 64
SAMPLES = 128
SLICE = 16 << 20
#: Bands of a text's level (about), and the neighbouring steps that each reads.
BANDS, BAND = 48, 14
#: Documents of unlike texts that share a band's value, from which on the value is split by as many steps again.
HOT = 256


@cache
def walk() -> np.ndarray:
    """For each kind of character and step (mod PERIOD): how many steps the walk stays on the character."""
    j = np.arange(PERIOD, dtype=np.uint64)
    out = np.empty((KINDS, PERIOD), np.uint8)
    for kind in range(KINDS):
        go = (C.mix(j * np.uint64(KINDS) + np.uint64(kind + 1)) >> np.uint64(40)) & np.uint64(1) == 1
        twice = np.append(np.flatnonzero(go), np.flatnonzero(go)[0] + PERIOD)
        out[kind] = twice[np.searchsorted(twice, np.arange(PERIOD))] - np.arange(PERIOD) + 1
    return out


@cache
def walk_rows() -> list[bytes]:
    return [x.tobytes() for x in walk()]


_levels = np.empty(0, np.uint8)


def levels(n: int) -> np.ndarray:
    """The level of each position below n."""
    global _levels
    if len(_levels) < n:
        h = C.mix(np.arange(1, max(n, 2 * len(_levels), 1 << 16) + 1, dtype=np.uint64)) | np.uint64(1 << 40)
        low = h & (~h + np.uint64(1))
        _levels = np.log2(low.astype(np.float64)).astype(np.uint8)
        sampled.cache_clear()
    return _levels


@cache
def sampled(level: int, size: int) -> np.ndarray:
    """Positions of at least the level, below a size that is a power of two."""
    return np.flatnonzero(levels(size)[:size] >= level)


def positions(level: int, below: int) -> np.ndarray:
    size = 1 << max(10, int(below).bit_length())
    levels(size)
    at = sampled(level, size)
    return at[: np.searchsorted(at, below)]


def level_of(n: int) -> int:
    return max(0, (n // SAMPLES).bit_length() - 1) if n else 0


def steps(kinds: np.ndarray, lo: np.ndarray, hi: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The step at which the walk reaches each character of kinds[lo:hi], from step begin; and the step after each text."""
    at = np.empty(len(kinds), np.int64)
    table, size = walk(), hi - lo
    order = np.argsort(-size, kind="stable")
    lo, size, j = lo[order], size[order], begin[order].astype(np.int64)
    n_longer = np.searchsorted(-size, -np.arange(int(size.max(initial=0)) + 1), side="left")
    i = 0
    while i < len(n_longer) - 1 and (n := n_longer[i]) >= 32:  # all texts longer than i take their step together
        where = lo[:n] + i
        at[where] = j[:n]
        j[:n] += table[kinds[where], j[:n] & (PERIOD - 1)]
        i += 1
    rows = walk_rows()
    for t in range(int(n_longer[i]) if i < len(n_longer) else 0):  # the few longest ones one by one
        now, own, text = int(j[t]), [], kinds[lo[t] + i : lo[t] + size[t]].tobytes()
        for k in text:
            own.append(now)
            now += rows[k][now & (PERIOD - 1)]
        at[lo[t] + i : lo[t] + size[t]] = own
        j[t] = now
    end = np.empty_like(j)
    end[order] = j
    return at, end


DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def fingerprint(digits: np.ndarray, at: np.ndarray, end: int) -> str:
    """Of one text: its characters' digits, the steps at which they begin, and the step after the last."""
    level = level_of(len(digits))
    kept = positions(level, end)
    return f"{level:x}:" + DIGITS[digits[np.searchsorted(at, kept, side="right") - 1]].tobytes().decode() if len(digits) else "0:"


def likeness(a: str, b: str) -> float:
    """The share of sampled positions at which two fingerprints agree."""
    if a == b:
        return 1.0
    (la, da), (lb, db) = a.split(":"), b.split(":")
    level = max(int(la, 16), int(lb, 16))
    x, y = digits_at(int(la, 16), da, level), digits_at(int(lb, 16), db, level)
    n = min(len(x), len(y))
    return float((x[:n] == y[:n]).sum()) / max(len(x), len(y), 1)


def digits_at(level: int, digits: str, coarser: int) -> np.ndarray:
    own = np.frombuffer(digits.encode(), np.uint8)
    if level == coarser or not len(own):
        return own
    size = 1 << 10
    while len(kept := sampled_upto(level, size)) < len(own):
        size *= 2
    return own[levels(size)[kept[: len(own)]] >= coarser]


def sampled_upto(level: int, size: int) -> np.ndarray:
    levels(size)
    return sampled(level, size)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    return cp, np.cumsum([0, *map(len, texts)])


def kinds_and_digits(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = cp * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return ((h >> np.uint32(20)) % KINDS).astype(np.uint8), ((h >> np.uint32(10)) & np.uint32(15)).astype(np.uint8)


def described(texts: list[str], followers: list[str]):
    """For each text: the edited text, and both fingerprints."""
    cp, offs = code_points(texts)
    kinds, digits = kinds_and_digits(cp)
    at, end = steps(kinds, offs[:-1], offs[1:], np.zeros(len(texts), np.int64))
    cut = [len(t) // 4 for t in texts]
    tails = [f[:m] for f, m in zip(followers, cut, strict=True)]
    tail_cp, tail_offs = code_points(tails)
    tail_kinds, tail_digits = kinds_and_digits(tail_cp)
    keep = offs[1:] - np.array(cut, np.int64)
    at_end = np.append(at, 0)
    begin = np.where(keep < offs[1:], at_end[np.minimum(keep, len(at))], end)  # the walk goes on from where the texts part
    tail_at, tail_end = steps(tail_kinds, tail_offs[:-1], tail_offs[1:], begin)
    for i, text in enumerate(texts):
        lo, hi, tl, th = offs[i], offs[i + 1], tail_offs[i], tail_offs[i + 1]
        own = fingerprint(digits[lo:hi], at[lo:hi], int(end[i]))
        k = keep[i]
        if cut[i]:
            edited = fingerprint(np.concatenate([digits[lo:k], tail_digits[tl:th]]), np.concatenate([at[lo:k], tail_at[tl:th]]), int(tail_end[i]))
        else:
            edited = own
        yield text[: len(text) - cut[i]] + tails[i], own, edited


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""

    def run(batches):
        for batch in batches:
            for part in C.slices(batch, SLICE):
                texts = [x or "" for x in part.column("text").to_pylist()]
                cp, offs = code_points(texts)
                kinds, digits = kinds_and_digits(cp)
                at, end = steps(kinds, offs[:-1], offs[1:], np.zeros(len(texts), np.int64))
                out = [fingerprint(digits[a:b], at[a:b], int(e)) for a, b, e in zip(offs[:-1], offs[1:], end, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(C.released(run), f"doc_id {kind}, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """Rows in ranges of doc_id, one range for each partition, each followed by the first row of the next range (`ghost`).

    Ranges come from quantiles, so the driver holds one bound for each partition; so do the rows that are copied.
    """
    spark = docs.sparkSession
    n = C.partitions(spark)
    ids = docs.select(F.col("doc_id").cast("double").alias("id"))
    bounds = sorted({int(x) for x in ids.approxQuantile("id", [i / n for i in range(1, n)], 0.1 / n)}) if n > 1 else []
    known = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    part = F.size(F.filter(known, lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part).cast("int"))
    first = rows.groupBy("part").agg(F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("null")).orderBy("part").collect()
    heads = [(r["part"], None if r["null"] else r["id"]) for r in first]
    ghosts = [(heads[i - 1][0], id_) for i, (_, id_) in enumerate(heads)]
    of = spark.createDataFrame([(p, i) for p, i in ghosts], T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType())]))
    wanted = [i for _, i in ghosts if i is not None]
    near = F.col("doc_id").isin(wanted) if wanted else F.lit(False)
    if any(i is None for _, i in ghosts):
        near = near | F.col("doc_id").isNull()
    copies = rows.where(near).drop("part").alias("r").join(F.broadcast(of.alias("o")), F.expr("r.doc_id <=> o.doc_id")).select("r.doc_id", "r.text", "o.part")
    both = rows.withColumn("ghost", F.lit(False)).unionByName(copies.withColumn("ghost", F.lit(True)))
    return both.repartitionById(n, "part").sortWithinPartitions("part", "ghost", "doc_id", "text")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame) -> DataFrame:
    """Every row with the fingerprints of its text and of the text whose last quarter the next document's beginning replaces."""

    def out(rows):
        if not rows:
            return
        texts = [r[1] for r in rows]
        made = list(described(texts[:-1], texts[1:]))
        last = next(described([texts[-1]], [""]))[1]
        prints = [m[1] for m in made] + [last]
        found = []
        for i, (edited, own, other) in enumerate(made):
            part, _, ghost, doc_id = rows[i][2], None, rows[i][3], rows[i][0]
            if not ghost and rows[i + 1][2] == part:
                found.append((doc_id, len(texts[i]), sha256(edited.encode()).hexdigest(), own, other, likeness(own, other), likeness(own, prints[i + 1])))
        if found:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=[x.split()[0] for x in RESULT.split(", ")])

    def run(batches):
        held = []  # the last row seen, which waits for its next one
        for batch in batches:
            for part in C.slices(batch, SLICE):
                columns = [part.column(c).to_pylist() for c in ("doc_id", "text", "part", "ghost")]
                rows = held + [(i, t or "", p, g) for i, t, p, g in zip(*columns, strict=True)]
                yield from out(rows)
                held = rows[-1:]

    return in_order(docs).mapInArrow(C.released(run), RESULT)


def band_level(n: int) -> int:
    """The level at which a text of n characters has about BANDS to 2 x BANDS places."""
    return max(0, int(n // BANDS).bit_length() - 1) if n else 0


def banded(texts: DataFrame) -> DataFrame:
    """texts (x, text) as (x, band, value, more): at each place of a text's level and the next coarser one, a hash of the steps there, and of twice as many.

    Each text walks forwards and backwards: behind an edit that shifts the text, walks take long to fall into step again,
    but before it they never part.
    """

    def run(batches):
        for batch in batches:
            for part in C.slices(batch, SLICE >> 3):
                own = [t or "" for t in part.column("text").to_pylist()]
                own = [*own, *(t[::-1] for t in own)]
                cp, offs = code_points(own)
                kinds, digits = kinds_and_digits(cp)
                at, end = steps(kinds, offs[:-1], offs[1:], np.zeros(len(own), np.int64))
                out: list[list] = [[], [], [], []]
                for i, (lo, hi) in enumerate(zip(offs[:-1], offs[1:], strict=True)):
                    if hi == lo:
                        continue
                    # the characters that the embedding shows, step by step
                    shown = np.repeat(cp[lo:hi], np.diff(np.append(at[lo:hi], end[i]))).astype(np.uint64)
                    key = C.grams(C.mix(np.append(shown, np.zeros(2 * BAND, np.uint64)) + np.uint64(1)), BAND)
                    for level in (band_level(hi - lo), band_level(hi - lo) + 1):
                        place = positions(level, len(shown))
                        value = C.mix(key[place] + np.uint64(level))
                        out[0].append(np.full(len(place), i % part.num_rows))
                        out[1].append(2 * place + i // part.num_rows)
                        out[2].append(value)
                        out[3].append(C.mix(value + C.BASE * key[place + BAND]))
                if out[0]:
                    i, place, value, more = (np.concatenate(c) for c in out)
                    yield pa.RecordBatch.from_arrays([part.column("x").take(pa.array(i)), pa.array(place, pa.int64()), pa.array(C.signed(value)), pa.array(C.signed(more))], names=["x", "band", "value", "more"])

    return texts.mapInArrow(C.released(run), "x string, band long, value long, more long")


def candidates(q: DataFrame, d: DataFrame) -> DataFrame:
    """(query, x) of unlike texts that share a band's value; q and d: written, x and text, each text once."""
    a, b = C.written(banded(q).withColumnRenamed("x", "query")), C.written(banded(d))
    hot = C.written(b.groupBy("band", "value").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("band", "value"))
    split = lambda rows: rows.join(hot, ["band", "value"], "left_semi").select(rows.columns[0], "band", F.col("more").alias("value"))
    whole = lambda rows: rows.join(hot, ["band", "value"], "left_anti").drop("more")
    pairs = whole(a).join(whole(b), ["band", "value"]).select("query", "x").unionByName(split(a).join(split(b), ["band", "value"]).select("query", "x"))
    return C.written(pairs.where("query != x").distinct())


def search(queries: DataFrame, docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(query_id, doc_id, likeness, distance) of documents whose edit distance from a query is at most (1 - least) x its length.

    Both sides have doc_id and text; a query doesn't find its own doc_id. An approximate search: a pair is found if the
    texts share a band. Of texts of 100 characters and more with up to a tenth of their characters edited, more than
    nine in ten pairs are found, wherever the edits stand (measured in the tests); nearer the bound, or in shorter texts, fewer.
    """
    alike = F.pandas_udf(lambda a, b: a.combine(b, likeness), T.DoubleType())
    text = F.coalesce("text", F.lit(""))
    q = C.written(queries.select(F.col("doc_id").alias("query_id"), F.sha2(text, 256).alias("query"), text.alias("query_text")))
    d = C.written(docs.select("doc_id", F.sha2(text, 256).alias("x"), text.alias("text")))
    of_q = C.written(q.groupBy(F.col("query").alias("x")).agg(F.first("query_text").alias("text")))
    of_d = C.written(d.groupBy("x").agg(F.first("text").alias("text")))
    prints = lambda rows, key, name: fingerprints(rows.select(F.col("x").alias("doc_id"), "text")).select(F.col("doc_id").alias(key), F.col("fingerprint").alias(name))
    pairs = candidates(of_q, of_d).join(prints(of_q, "query", "one"), "query").join(prints(of_d, "x", "other"), "x")
    pairs = pairs.withColumn("likeness", alike("one", "other")).where(F.col("likeness") >= least - 0.7)
    pairs = pairs.join(of_q.select(F.col("x").alias("query"), F.col("text").alias("query_text")), "query").join(of_d, "x")
    allowed = F.floor((1 - least) * F.length("query_text")).cast("int")
    # the built-in edit distance, only for pairs whose lengths allow it
    near = pairs.where(F.abs(F.length("text") - F.length("query_text")) <= allowed).withColumn("distance", F.levenshtein("query_text", "text"))
    near = near.where(F.col("distance") <= allowed).select("query", "x", "likeness", "distance")
    same = of_q.join(of_d.select("x"), "x").select(F.col("x").alias("query"), "x", F.lit(1.0).alias("likeness"), F.lit(0).alias("distance"))
    found = C.written(near.unionByName(same))
    out = q.select("query_id", "query").join(found, "query").join(d.select("doc_id", "x"), "x")
    return out.where(~F.col("query_id").eqNullSafe(F.col("doc_id"))).select("query_id", "doc_id", "likeness", "distance")


def op3_edit_fingerprints(spark, sf_dir) -> DataFrame:
    return with_next(C.table(spark, sf_dir, "documents"))
