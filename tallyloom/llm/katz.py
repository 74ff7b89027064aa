"""LM scoring with Katz backoff.

The model gives a token w after a token h
    p(w | h) = d(c(hw)) c(hw) / (c(h) + 1)      if hw was seen in training,
               a(h) p(w)                        if not,
    p(w)     = g d(c(w)) c(w) / N               for a word seen in training, and the rest of 1 for unknown words.
d are Good-Turing discounts by Katz's formula for counts up to CUT (others are not discounted), a(h) makes the sum over
all words exactly 1: the mass that h's seen pairs leave, over the mass that they leave in p. One count after each h is
kept for the unseen, so the mass is never 0. Two kinds of counts are stored: of words and of pairs of words, all of
them, in a table with a row for each hash bucket. Nothing is pruned.

The CACHE most frequent words and up to HOT frequent pairs of them are broadcast with their counts. Which words and pairs
these are changes costs, not results: the words come from the counts of all, the pairs from a sample of at most about
SAMPLE documents; then both are counted in all training documents. A cached pair is scored where it stands and never
sent anywhere, so no bucket meets one that stands in a large part of all documents.

How it runs: words and cached pairs are counted; then every document is read again and each slice of documents sends its
distinct pairs, with the documents that hold them, to a bucket, of which there are as many as hold BUCKET tokens each: pairs of cached words to that of the first word (frequent first words
are spread over several buckets by the second), pairs with a second word outside the cache to the second word's, others
to the first word's. The bucket counts the training documents among them (and so the words outside the cache, each of
which it sees with all its pairs), stores its counts, and answers each slice with the count of each pair that it asked for,
or with sums by document where these are fewer. A pair that wasn't seen is answered with its first word, whose backoff
weight is looked up: in an array for cached words, by a join for all others. A last step adds up each slice's answers.

`scored` with a vocabulary is a smaller model, of that many words and one class of all others, within which each word has
its own share g d(c(w)) c(w) / N; the query doesn't use it.

Defined results: a null or empty text, or one of white space, is its end token alone; without training documents N and
V are 0, and every word is unknown; repeated rows are counted and scored as often as they stand there; ties need no
order; a very long text is handled whole, in memory of about 200 bytes a token. Words are identified by 64-bit hashes.
Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

CACHE = 1 << 18
CUT = 5
GATHER = 2_000_000
HOT, SAMPLE = 1 << 16, 10_000
#: Tokens of a bucket (about): what a task holds at once, whatever the corpus.
BUCKET = 1_500_000
#: Pairs that are answered at once (about, and at least a slice's).
ANSWER = 100_000
#: The end of a text, as a token.
END = np.uint64(0xE4D0F7E87)
RARE = np.uint64(1) << np.uint64(63)
#: Stands for a null doc_id between the steps.
NO_ID = -(1 << 63)


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each token, each document's end included."""
    data = C.LOWER[data]
    starts, ends, doc = C.spans(data, offs, C.NOT_SPACE)
    n = len(offs) - 1
    out = np.full(len(starts) + n, END, np.uint64)
    at = np.arange(len(starts)) + doc
    out[at] = C.word_hashes(data, starts, ends)
    docs = np.empty(len(out), np.int64)
    docs[at] = doc
    docs[np.searchsorted(doc, np.arange(1, n + 1)) + np.arange(n)] = np.arange(n)
    return out, docs


def gathered(batches) -> Iterator[np.ndarray]:
    """The tokens of texts, at most about GATHER at once."""
    held, size = [], 0
    for batch in batches:
        for part in C.slices(batch):
            held.append(tokens(*C.utf8(part.column("text")))[0])
            size += len(held[-1])
            if size > GATHER:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def pair_keys(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token before each, and a key of both; before a text's first token stands the end of another."""
    first = np.append(END, w[:-1])
    return first, C.mix(first * C.BASE + w)


def frequent_pairs(texts: DataFrame) -> np.ndarray:
    """Rows (key, first, second) of at most HOT pairs that are frequent in a sample of texts, by key."""

    def count(batches):
        for w in gathered(batches):
            first, key = pair_keys(w)
            _, at, c = np.unique(key, return_index=True, return_counts=True)
            at, c = at[c > CUT], c[c > CUT]
            yield pa.RecordBatch.from_arrays([pa.array(C.signed(x[at])) for x in (key, first, w)] + [pa.array(c, pa.int64())], names=["key", "first", "second", "c"])

    share = int((1 << 20) * min(1.0, SAMPLE / max(texts.count(), 1)))
    some = texts.select("text").where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share)
    found = some.mapInArrow(C.released(count), "key long, first long, second long, c long").groupBy("key", "first", "second").agg(F.sum("c").alias("c"))
    top = found.orderBy(F.desc("c"), "key").limit(HOT).select("key", "first", "second").toPandas().to_numpy(np.int64).reshape(-1, 3).view(np.uint64)
    return top[np.argsort(top[:, 0])]


def counts(texts: DataFrame, pairs: np.ndarray) -> DataFrame:
    """Written, a folder for each kind: (w, c) of all words of texts (kind 0), and of the given pairs by their keys (kind 1)."""
    shared = texts.sparkSession.sparkContext.broadcast(pairs[:, 0].copy())

    def count(batches):
        for w in gathered(batches):
            _, key = pair_keys(w)
            for kind, values in enumerate((w, key[holds(shared.value, key)])):
                values, c = np.unique(values, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), kind, np.int8)), pa.array(C.signed(values)), pa.array(c, pa.int64())], names=["kind", "w", "c"])

    rows = texts.select("text").mapInArrow(C.released(count), "kind byte, w long, c long").groupBy("kind", "w").agg(F.sum("c").alias("c"))
    return C.written(rows, partition_by="kind")


def holds(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are among sorted keys."""
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values if len(keys) else np.zeros(len(values), bool)


def discounts(n: list[int]) -> np.ndarray:
    """d(0..CUT) from n[r], how many have count r, r up to CUT + 1; d(0) is unused."""
    d = np.ones(CUT + 1)
    common = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        value = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r  # too few counts for Good-Turing: half a count is taken
    return d


class Unigrams:
    """The word level of the model; its arrays have at most vocabulary + 2 entries. open: words outside it stand for themselves."""

    def __init__(self, table: DataFrame, vocabulary: int, open: bool, pairs: np.ndarray):
        """table: see counts; pairs: those that are counted there."""
        self.open = open
        counts = table.where("kind = 0").select("w", "c")
        end = int(END.view(np.int64))
        level = F.when(F.col("c") < 65536, F.col("c")).otherwise(65536 + F.floor(256 * F.log2("c"))).cast("long")
        words = counts.withColumn("level", level)
        # one row for each count below 65536 and for each 256th of a doubling above
        hist = sorted((r["level"], r["v"], r["n"]) for r in words.groupBy("level").agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect())
        self.n, self.v = sum(x[2] for x in hist), sum(x[1] for x in hist)
        self.scale = float(np.log10(self.n + 0.5 * (self.v + 1)))
        exact = {k: v for k, v, _ in hist}
        self.d = discounts([0, *(exact.get(r, 0) for r in range(1, CUT + 2))])
        least, size = 1 << 40, 0
        for k, v, _ in reversed(hist):
            if size + v > vocabulary:
                break
            least, size = k, size + v
        top = words.where((F.col("level") >= least) | (F.col("w") == end)).select("w", "c").toPandas()
        w, c = top["w"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
        order = np.argsort(w[w != END])
        self.words = w[w != END][order]
        self.size = len(self.words) + 2  # symbols: the end, the vocabulary, all other words
        count = np.concatenate([[c[w == END].sum()], c[w != END][order], [0]]).astype(np.float64)
        count[-1] = self.n - count.sum()
        self.count = count
        known = sum(self.discounted(np.array([k if k < 65536 else CUT + 1]))[0] / k * n if k < 65536 else n for k, _, n in hist)
        scale = self.n / (self.n + 1)  # one count is kept for unknown words
        self.g = scale / max(self.n, 1)
        self.unknown = 1 - self.g * known
        p = self.g * self.discounted(count)
        p[-1] = max(1 - p[:-1].sum(), self.unknown)
        if not self.n:
            p[0], p[-1] = 0.5, 0.5
            self.unknown = 0.5
        self.p = p
        # cached pairs, as first symbol x size + second; seldom ones are left to the buckets, which discount them
        hot = table.where(f"kind = 1 AND c > {CUT + 1}").select("w", "c").toPandas()
        at = np.searchsorted(pairs[:, 0], hot["w"].to_numpy(np.int64).view(np.uint64))
        first, second, c = self.ids(pairs[at, 1]), self.ids(pairs[at, 2]), hot["c"].to_numpy(np.int64)
        known = (first != self.size - 1) & (second != self.size - 1)
        key = (first * self.size + second)[known].astype(np.uint64)
        order = np.argsort(key)
        self.hot, self.hot_count = key[order], c[known][order]

    def discounted(self, c: np.ndarray) -> np.ndarray:
        c = np.asarray(c)
        return np.where(c <= CUT, self.d[np.minimum(c, CUT).astype(int)], 1.0) * c

    def ids(self, w: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.where(w == END, 0, self.size - 1)
        at = np.minimum(np.searchsorted(self.words, w), len(self.words) - 1)
        return np.where(w == END, 0, np.where(self.words[at] == w, at + 1, self.size - 1))


#: What slices send to buckets. kind 0: pairs of symbols, and in a model with a class its words (docs: twice the document's
#: number in the slice, plus 1 if it is in training), then pairs with a word outside the cache (first, second: the symbol, or
#: the word's hash); kind 1: the slice's documents, with what the slice knows itself.
SENT = "bucket int, slice long, kind byte, keys array<long>, lens array<int>, docs array<int>, first array<long>, second array<long>, open_lens array<int>, open_docs array<int>, ids array<long>, held array<boolean>, n array<int>, known array<int>, base array<double>, score array<double>"
#: What buckets write. kind 0: answers to a slice, see answers; kind 1: as sent; kind 2: counts of counts; kind 3: sums by first
#: word; kind 4: counts of pairs; kind 5: counts of pairs whose first word is outside the cache (mass: the second one's p);
#: kind 6: documents of a slice and first words outside the cache of their unseen pairs; kind 7: counts of pairs of a cached
#: first word with another.
TABLE = "slice long, kind byte, ids array<long>, held array<boolean>, n array<int>, known array<int>, base array<double>, score array<double>, seen array<int>, low array<int>, high array<long>, high_docs array<int>, docs array<int>, keys array<long>, second array<long>, mass array<double>, rare array<long>, rare_docs array<int>"


def schema_of(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "byte": pa.int8(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [x.split(" ") for x in ddl.split(", ")]
    return pa.schema([(n, pa.list_(kinds[t[6:-1]]) if t.startswith("array") else kinds[t]) for n, t in fields])


def rows(ddl: str, found: list[dict]) -> pa.Table:
    schema = schema_of(ddl)
    columns = []
    for f in schema:
        values = [r.get(f.name) for r in found]
        if pa.types.is_list(f.type):
            sizes = [0 if v is None else len(v) for v in values]
            flat = np.concatenate([np.asarray(v) for v in values if v is not None and len(v)]) if sum(sizes) else np.empty(0)
            columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat).cast(f.type.value_type) if len(flat) else pa.array([], f.type.value_type)))
        else:
            columns.append(pa.array(values, f.type))
    return pa.Table.from_arrays(columns, schema=schema)


def filled(ddl: str, n: int, found: dict[str, pa.Array]) -> pa.Table:
    """n rows with the columns found; all others are null."""
    schema = schema_of(ddl)
    return pa.Table.from_arrays([found[f.name].cast(f.type) if f.name in found else pa.nulls(n, f.type) for f in schema], schema=schema)


def listed(sizes: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """A list for each size, of values that stand one after the other."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))


def lists(column) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the bounds of each row's."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths().fill_null(0))
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])


def holders(held: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Twice the document's number, plus 1 if it is in training."""
    return doc * 2 + ~held[doc]


def runs(bucket: np.ndarray, keys: list[np.ndarray], holder: np.ndarray, n_buckets: int) -> list[pa.ListArray]:
    """Lists for each bucket: of its distinct keys, of how many holders each has, and of the holders."""
    order = np.lexsort((holder, *keys[::-1], bucket))
    bucket, holder, keys = bucket[order], holder[order], [k[order] for k in keys]
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    size = lambda x: np.bincount(x.astype(np.int64), minlength=n_buckets)
    n = size(bucket[first])
    return [*(listed(n, C.signed(k[first])) for k in keys), listed(n, np.diff(np.append(first, len(bucket)))), listed(size(bucket), holder)]


def sent(docs: DataFrame, held_out: Column, model, n_buckets: int) -> DataFrame:
    """docs: doc_id, text. SENT rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        u = shared.value
        spread = np.maximum(1, np.ceil(u.count * 4 * n_buckets / max(u.n, 1))).astype(np.uint64)
        log_base = np.log10(u.count + 0.5) - u.scale
        task, turn = TaskContext.get().partitionId(), 0
        size, rare_id = np.uint64(u.size), u.size - 1
        for batch in batches:
            for part in C.slices(batch):
                w, doc = tokens(*C.utf8(part.column("text")))
                held = np.asarray(part.column("held").to_numpy(zero_copy_only=False), bool)
                number = (task << 32) + turn
                turn += 1
                i = u.ids(w)
                h = np.zeros_like(i)
                h[1:] = i[:-1]  # before a text's first token stands the end of another
                iu, hu = i.astype(np.uint64), h.astype(np.uint64)
                rare = i == rare_id
                pair = hu * size + iu
                hot = holds(u.hot, pair)
                c = u.hot_count[np.searchsorted(u.hot, pair[hot])]
                before = np.roll(rare, 1)
                before[:1] = False
                plain = ~(rare | before | hot) if u.open else ~hot
                alone = np.zeros_like(rare) if u.open else rare
                key = np.concatenate([pair[plain], w[alone] | RARE])
                bucket = np.concatenate([C.mix((hu[plain] << np.uint64(24)) + iu[plain] % spread[h[plain]]), C.mix(w[alone])]) % np.uint64(n_buckets)
                n_docs = part.num_rows
                found = dict(zip(("keys", "lens", "docs"), runs(bucket, [key], holders(held, np.concatenate([doc[plain], doc[alone]])), n_buckets), strict=True))
                if u.open:
                    at = np.flatnonzero(rare | before)
                    second = np.where(rare[at], w[at], iu[at])
                    first = np.where(before[at], w[at - 1], hu[at])
                    bucket = C.mix(np.where(rare[at], second, first)) % np.uint64(n_buckets)
                    found |= zip(("first", "second", "open_lens", "open_docs"), runs(bucket, [first, second], holders(held, doc[at]), n_buckets), strict=True)
                found |= {"bucket": pa.array(range(n_buckets)), "slice": pa.array(np.full(n_buckets, number)), "kind": pa.array(np.zeros(n_buckets, np.int8))}
                used = pc.greater(pc.add(pc.list_value_length(found["docs"]), pc.list_value_length(found["open_docs"]) if u.open else 0), 0)
                yield from filled(SENT, n_buckets, found).filter(used).to_batches()
                known = np.bincount(doc[~rare & (u.count[i] > 0)], minlength=n_docs)
                base = np.bincount(doc[~rare], weights=log_base[i[~rare]], minlength=n_docs)
                # all that a first word in the cache divides by is known here
                over = np.ones_like(hot) if not u.open else ~before
                score = np.bincount(doc[hot], weights=np.log10(c), minlength=n_docs) - np.bincount(doc[over], weights=np.log10(u.count[h[over]] + 1), minlength=n_docs)
                own = {"bucket": number % n_buckets, "slice": number, "kind": 1, "ids": part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False), "held": held, "n": np.bincount(doc, minlength=n_docs), "known": known, "base": base, "score": score}
                yield from rows(SENT, [own]).to_batches()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held"))
    return texts.mapInArrow(C.released(run), SENT)


def sums(h: np.ndarray, c: np.ndarray, p: np.ndarray):
    """The rows of kinds 2 and 3 of pairs with a cached first word h."""
    hs, at = np.unique(h, return_inverse=True)
    by_level = np.bincount(at[c <= CUT] * CUT + c[c <= CUT] - 1, minlength=len(hs) * CUT)
    rest = np.bincount(at[c > CUT], weights=c[c > CUT], minlength=len(hs))
    mass = np.bincount(at, weights=p, minlength=len(hs))
    yield from rows(TABLE, [{"kind": 2, "keys": levels(c)}, {"kind": 3, "keys": hs, "seen": by_level, "mass": np.concatenate([rest, mass])}]).to_batches()


def levels(c: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(c, CUT + 2), minlength=CUT + 3)[: CUT + 2]


def row_of(at: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def dense(row: np.ndarray, place: np.ndarray, sizes: np.ndarray, weights: np.ndarray | None = None) -> pa.ListArray:
    """For each row a list of so many sums, by place."""
    start = np.cumsum(sizes) - sizes
    return listed(sizes, np.bincount(start[row] + place, weights=weights, minlength=int(sizes.sum())))


def answers(number: np.ndarray, pairs: dict[str, np.ndarray], rare: list[np.ndarray], u: Unigrams) -> Iterator[pa.RecordBatch]:
    """A bucket's rows of kinds 0 and 6 for slices of those numbers. What they hold grows with the pairs, not with buckets x documents: a list of what is known of each pair, or sums by document where these are fewer.

    pairs: row, document, count, first symbol, whether the first word is cached, the word, log10 p of the second. rare: row,
    document and count of words outside the cache.
    low: document * CUT + count - 1 of seldom seen pairs, or seen: how many there are of each such number; high_docs, high: count
    of other seen pairs, or score: sums of their logarithms; docs, keys, mass: of unseen ones, to which the first symbol's backoff
    weight is added (u.size: the word is outside the cache, and its weight looked up, by kind 6); rare_docs, rare: of words.
    """
    n = len(number)
    order = np.argsort(pairs["row"], kind="stable")
    row, d, c, h, cached, first, log_p = (pairs[k][order] for k in ("row", "d", "c", "h", "cached", "first", "log_p"))
    size = lambda some: np.bincount(row[some], minlength=n)
    docs = np.zeros(n, np.int64)
    np.maximum.at(docs, row, d + 1)
    low, high, open_ = (c > 0) & (c <= CUT), c > CUT, c == 0
    many_low, many_high = 4 * size(low) > CUT * docs, 2 * size(high) > 3 * docs
    few = lambda some, many: some & ~many[row]
    full = lambda some, many: some & many[row]
    found = {"slice": pa.array(number), "kind": pa.array(np.zeros(n, np.int8))}
    at = full(low, many_low)
    found["seen"] = dense(row[at], d[at] * CUT + c[at] - 1, np.where(many_low, CUT * docs, 0))
    at = few(low, many_low)
    found["low"] = listed(size(at), d[at] * CUT + c[at] - 1)
    at = full(high, many_high)
    found["score"] = dense(row[at], d[at], np.where(many_high, docs, 0), np.log10(c[at]))
    at = few(high, many_high)
    found["high"], found["high_docs"] = listed(size(at), c[at]), listed(size(at), d[at])
    found["docs"], found["keys"] = listed(size(open_), d[open_]), listed(size(open_), np.where(cached, h, u.size)[open_])
    found["mass"] = listed(size(open_), (log_p + np.where(cached, np.log10(u.count[h] + 1), 0.0))[open_])
    order = np.argsort(rare[0], kind="stable")
    words = np.bincount(rare[0], minlength=n)
    found["rare"], found["rare_docs"] = listed(words, rare[2][order]), listed(words, rare[1][order])
    yield from filled(TABLE, n, found).to_batches()
    far = open_ & ~cached
    if far.any():
        found = {"slice": pa.array(number), "kind": pa.array(np.full(n, 6, np.int8)), "docs": listed(size(far), d[far]), "keys": listed(size(far), C.signed(first[far]))}
        yield from filled(TABLE, n, found).filter(pa.array(size(far) > 0)).to_batches()


class Others:
    """A bucket's pairs with a word outside the cache. It holds all pairs of such a second word, and so its count."""

    def __init__(self, own: pa.Table, u: Unigrams):
        self.u = u
        (first, self.key_at), (second, _), (lens, _), (docs, self.doc_at) = (lists(own.column(c)) for c in ("first", "second", "open_lens", "open_docs"))
        first, second = (x.astype(np.int64, copy=False).view(np.uint64) for x in (first, second))
        order = np.lexsort((first, second))
        f, s = first[order], second[order]
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
        self.of = np.empty(len(f), np.int32)
        self.of[order] = np.cumsum(new) - 1
        self.first, self.second = f[new], s[new]
        self.lens, self.docs = lens.astype(np.int64), docs.astype(np.int64)
        trained = np.add.reduceat(self.docs & 1, np.cumsum(self.lens) - self.lens) if len(lens) else np.empty(0)
        self.c = np.bincount(self.of, weights=trained, minlength=len(self.first)).astype(np.int64)
        self.cached = self.first < u.size
        self.rare = self.second >= u.size
        _, word = np.unique(self.second, return_inverse=True)
        total = np.bincount(word, weights=self.c)[word] if len(word) else np.empty(0)
        symbol = np.where(self.rare, 0, self.second).astype(np.int64)
        self.p = np.where(self.rare, np.where(total > 0, u.g * u.discounted(total), u.unknown), u.p[symbol])
        self.total = np.where(self.rare, total, 0).astype(np.int64)

    def entries(self, lo: int, hi: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """See answers, of slices lo to hi: their pairs, and row, document and count of the words outside the cache that are second ones."""
        at = slice(self.key_at[lo], self.key_at[hi])
        e = np.repeat(self.of[at], self.lens[at])
        row, d, rare = row_of(self.doc_at[lo : hi + 1]), self.docs[self.doc_at[lo] : self.doc_at[hi]] >> 1, self.rare[e]
        # what a first word outside the cache divides by comes from its own bucket, where it is the second word
        return {"row": row, "d": d, "c": self.c[e], "h": np.where(self.cached[e], self.first[e], 0).astype(np.int64), "cached": self.cached[e], "first": self.first[e], "log_p": np.log10(self.p[e])}, row[rare], d[rare], self.total[e[rare]]

    def stored(self):
        seen = self.c > 0
        near, far = seen & self.cached, seen & ~self.cached
        if near.any():
            yield from sums(self.first[near].astype(np.int64), self.c[near], self.p[near])
            yield from rows(TABLE, [{"kind": 7, "keys": C.signed(self.first[near]), "second": C.signed(self.second[near]), "seen": self.c[near]}]).to_batches()
        if far.any():
            yield from rows(TABLE, [{"kind": 2, "keys": levels(self.c[far])}]).to_batches()
            yield from rows(TABLE, [{"kind": 5, "keys": C.signed(self.first[far]), "second": C.signed(self.second[far]), "seen": self.c[far], "mass": self.p[far]}]).to_batches()


def answered(received: DataFrame, model, n_buckets: int) -> DataFrame:
    """Written: TABLE rows, of which kinds 4, 5 and 7 are the table of pair counts."""
    shared = received.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = shared.value
        table = pa.Table.from_batches(batches)
        kind = np.asarray(table.column("kind"))
        for r in np.flatnonzero(kind == 1):
            row = table.slice(r, 1)
            yield from rows(TABLE, [{"slice": row["slice"][0].as_py(), "kind": 1, **{c: lists(row[c])[0] for c in ("ids", "held", "n", "known", "base", "score")}}]).to_batches()
        own = table.filter(pa.array(kind == 0)).select(["slice", "keys", "lens", "docs", "first", "second", "open_lens", "open_docs"])
        del table
        number = np.asarray(own.column("slice"))
        (keys, key_at), (lens, _), (docs, doc_at) = (lists(own.column(c)) for c in ("keys", "lens", "docs"))
        distinct, of = np.unique(keys.astype(np.int64, copy=False).view(np.uint64), return_inverse=True)
        of = of.astype(np.int32)
        # lens are 1 and more, so each key's documents are a run of their own
        trained = np.add.reduceat(docs & 1, np.cumsum(lens) - lens) if len(lens) else np.empty(0)
        c = np.bincount(of, weights=trained, minlength=len(distinct)).astype(np.int64)
        pair = distinct < RARE
        h, w = (x.astype(np.int64) for x in np.divmod(np.where(pair, distinct, 0), np.uint64(u.size)))
        seen = c > 0
        more = Others(own, u)
        del own
        with np.errstate(divide="ignore"):
            log_p = np.log10(u.p)
        asked = doc_at + more.doc_at
        for lo, hi in itertools.pairwise(np.unique(np.append(np.searchsorted(asked, np.arange(0, asked[-1], ANSWER)), len(number)))):
            at = slice(key_at[lo], key_at[hi])
            e = np.repeat(of[at], lens[at])
            row, d, p = row_of(doc_at[lo : hi + 1]), docs[doc_at[lo] : doc_at[hi]].astype(np.int64) >> 1, pair[e]
            mine = {"row": row[p], "d": d[p], "c": c[e[p]], "h": h[e[p]], "cached": np.ones(p.sum(), bool), "first": h[e[p]].astype(np.uint64), "log_p": log_p[w[e[p]]]}
            alone = row[~p], d[~p], c[e[~p]]
            others, *words = more.entries(lo, hi)
            yield from answers(number[lo:hi], {k: np.concatenate([mine[k], others[k]]) for k in mine}, [np.concatenate(x) for x in zip(alone, words, strict=True)], u)
        stored = pair & seen
        cs = c[stored]
        yield from sums(h[stored], cs, u.p[w[stored]])
        yield from rows(TABLE, [{"kind": 4, "keys": C.signed(distinct[stored]), "seen": cs}]).to_batches()
        yield from more.stored()
        C.give_back()

    # a task for each bucket, so that what a task reads is bounded, too
    return C.written(received.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(count, TABLE), partition_by="kind")


def backoff(table: DataFrame, u: Unigrams) -> tuple[np.ndarray, np.ndarray]:
    """Discounts of pairs, and log10 a(h) for each symbol."""
    n = {r["r"]: r["n"] for r in table.where("kind = 2").select(F.posexplode("keys").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect()}
    d = discounts([int(n.get(r, 0)) for r in range(CUT + 2)])
    part = table.where("kind = 3").select("keys", "seen", "mass", F.posexplode("keys").alias("i", "h"))
    discounted = sum((F.try_element_at("seen", F.col("i") * CUT + r).cast("double") * float(d[r] * r) for r in range(1, CUT + 1)), F.try_element_at("mass", F.col("i") + 1))
    part = part.select("h", discounted.alias("c"), F.try_element_at("mass", F.size("keys") + F.col("i") + 1).alias("p"))
    got = part.groupBy("h").agg(F.sum("c").alias("c"), F.sum("p").alias("p")).toPandas()  # at most one row for each symbol
    h, (hot_first, hot_second) = got["h"].to_numpy(np.int64), np.divmod(u.hot.astype(np.int64), u.size)
    taken, mass = (np.bincount(hot_first, weights=x, minlength=u.size).astype(np.float64) for x in (u.hot_count, u.p[hot_second]))
    taken[h] += got["c"].to_numpy()
    mass[h] += got["p"].to_numpy()
    left, free = 1 - taken / (u.count + 1), 1 - mass
    return d, np.log10(np.maximum(left, 1e-300)) - np.log10(np.maximum(free, 1e-12))


def looked_up(table: DataFrame, d: np.ndarray) -> DataFrame:
    """Rows of kind 6 with the weights of unseen pairs whose first word is outside the cache: what its seen pairs leave, times c(h) + 1."""
    pair = table.where("kind = 5").select(F.explode(F.arrays_zip("keys", "seen", "mass")).alias("x")).select(F.col("x.keys").alias("h"), F.col("x.seen").alias("c"), F.col("x.mass").alias("p"))
    taken = F.when(F.col("c") <= CUT, (1 - F.element_at(F.array(*map(F.lit, d[1:].tolist())), F.least("c", F.lit(CUT)))) * F.col("c")).otherwise(0.0)
    weight = pair.groupBy("h").agg(F.sum(taken).alias("taken"), F.sum("p").alias("p"))
    weight = weight.select("h", (F.log10(F.greatest(1 + F.col("taken"), F.lit(1e-300))) - F.log10(F.greatest(1 - F.col("p"), F.lit(1e-12)))).alias("a"))
    asked = table.where("kind = 6").select("slice", F.explode(F.arrays_zip("docs", "keys")).alias("x")).select("slice", F.col("x.docs").alias("doc"), F.col("x.keys").alias("h"))
    # a word that no training document holds leaves everything: 0
    found = asked.join(weight, "h").groupBy("slice").agg(F.collect_list(F.struct("doc", "a")).alias("x"))
    names = [f.split(" ")[0] for f in TABLE.split(", ")]
    own = {"slice": F.col("slice"), "kind": F.lit(6).cast("byte"), "docs": F.col("x.doc"), "score": F.col("x.a")}
    return found.select(*[own.get(c, F.lit(None)).cast(table.schema[c].dataType).alias(c) for c in names])


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def summed(table: DataFrame, u: Unigrams, d: np.ndarray, log_a: np.ndarray) -> DataFrame:
    """The result rows of each slice's documents."""
    total, scale = u.n, u.scale
    # the weight of what is looked up elsewhere is 0 here; a class of words shares what it has by each word's own
    shared = table.sparkSession.sparkContext.broadcast((np.log10(d[1:]), np.append(log_a, 0.0), u.open, u.g, u.d, u.unknown, u.p[-1]))

    def add(part: pa.Table) -> pa.Table:
        log_d, log_a, open_, g, d_words, unknown, rest = shared.value
        kind = np.asarray(part.column("kind"))
        top = part.slice(int(np.flatnonzero(kind == 1)[0]), 1)
        ids, held, n, known, base, score = (lists(top[c])[0] for c in ("ids", "held", "n", "known", "base", "score"))
        known, base, score = known.astype(np.int64), base.astype(np.float64), score.astype(np.float64)
        own = part.filter(pa.array(kind == 0))
        flat = lambda c, kind: lists(own[c])[0].astype(kind, copy=False)
        place = lambda at: np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))
        sums = lambda docs, weights, k=1: np.bincount(docs, weights=weights, minlength=len(n) * k)
        (seen, at), (high, high_at) = lists(own["seen"]), lists(own["score"])
        seldom = sums(place(at), seen.astype(np.int64), CUT) + sums(flat("low", np.int64), None, CUT)
        score += seldom.reshape(-1, CUT) @ (np.log10(np.arange(1, CUT + 1)) + log_d)
        score += sums(place(high_at), high.astype(np.float64)) + sums(flat("high_docs", np.int64), np.log10(flat("high", np.int64)))
        score += sums(flat("docs", np.int64), flat("mass", np.float64) + log_a[flat("keys", np.int64)])
        words, c = flat("rare_docs", np.int64), flat("rare", np.int64)
        known += sums(words[c > 0], None)
        base += sums(words, np.log10(c + 0.5) - scale)
        if open_:
            score -= sums(words, np.log10(c + 1))  # what follows such a word is over its count
        else:
            share = np.where(c > 0, g * np.where(c <= CUT, d_words[np.minimum(c, CUT)], 1.0) * c, unknown)
            score += sums(words, np.log10(share) - np.log10(rest))
        for r in np.flatnonzero(kind == 6):
            own = part.slice(r, 1)
            score += np.bincount(lists(own["docs"])[0].astype(np.int64), weights=lists(own["score"])[0], minlength=len(n))
        out = [pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(held.astype(bool)), pa.array(n, pa.int64()), pa.array(known), pa.array(np.full(len(n), total), pa.int64()), pa.array(base), pa.array(score)]
        return pa.Table.from_arrays(out, names=[x.split()[0] for x in RESULT.split(", ")])

    answers = table.where("kind IN (0, 1)")
    if u.open:
        answers = answers.unionByName(looked_up(table, d))
    return answers.groupBy("slice").applyInArrow(add, RESULT)


def scored(docs: DataFrame, held_out: Column, vocabulary: int | None = None) -> DataFrame:
    """RESULT for every row, from a model of those that aren't held out; given a vocabulary, with one class of all other words."""
    C.bounded_batches(docs.sparkSession)
    held_out = F.coalesce(held_out, F.lit(False))  # a null doc_id isn't held out
    training = docs.where(~held_out)
    pairs = frequent_pairs(training)
    u = Unigrams(counts(training, pairs), CACHE if vocabulary is None else vocabulary, vocabulary is None, pairs)
    n = u.n * docs.count() / max(1, training.count())
    n_buckets = max(1, int(n / BUCKET))
    table = answered(sent(docs, held_out, u, n_buckets), u, n_buckets)
    return summed(table, u, *backoff(table, u))


def op2_katz_backoff(spark, sf_dir) -> DataFrame:
    return scored(C.table(spark, sf_dir, "documents"), C.remainder("doc_id", 5) == 1)
