"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counts of every (language, n-gram bucket) come from all labelled training texts; the matrix of log-probabilities has
languages x BUCKETS entries whatever the corpus holds, so it is broadcast, and each task scores its own texts with it.

The pipeline's stage asks of each text whether the model of its language explains it at all: whether its n-grams are
likelier under that model than under both of two models of no language, one with all buckets alike (for letters that
the model never saw) and one with the language's letters in random order (for strings of letters that form no words).
A text goes if the weight of evidence against its language exceeds a threshold set from all labelled texts. The stage
learns from all of them, too; only op1, which is measured on them, holds a quarter out.
Parts with a digit, @ or = (keys, addresses, numbers) are no words and don't count.

Defined results: a null text or one without a letter gives `und` and 0.0; a null language is not learned from; ties go
to the first language in alphabetical order; with nothing to learn from, every text is `und`; repeated rows get equal
results; a very long text is handled whole, in memory of about 60 times its characters; other columns are not read,
whatever their names.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.1
#: The share of labelled texts that the stage's threshold keeps at least.
KEPT = 0.999
#: Evidence against a text's language, in natural logarithms, that never suffices to reject it.
EVIDENCE = 20.0
#: Parts between white space that are no words.
NO_WORD = r"(?<!\S)[^\s0-9@=]*+[0-9@=]\S*+"


@cache
def letters() -> np.ndarray:
    """Each code point's lower-case letter, or a space if it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def buckets(data: np.ndarray, offs: np.ndarray):
    """For each order: the bucket of each n-gram and the bounds of each document; and which documents have a letter."""
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = lead[offs]
    n_docs = len(offs) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(bounds))
    at = np.arange(len(cp)) + 2 * doc + 1  # a space goes before and after each text
    seq = np.full(len(cp) + 2 * n_docs, 32, np.uint32)
    seq[at] = letters()[cp]
    bounds = bounds + 2 * np.arange(n_docs + 1)
    letter = np.concatenate([[0], np.cumsum(seq != 32)])
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != 32) | (seq[:-1] != 32)
    keep[bounds[:-1]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    has = letter[bounds[1:]] > letter[bounds[:-1]]
    seq, bounds = seq[keep], kept[bounds]
    out, h = [], np.zeros(len(seq), np.uint32)
    for k in range(1, max(ORDERS) + 1):
        h = h[: len(seq) - k + 1]
        h = (h ^ seq[k - 1 :]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if k in ORDERS:
            # n-grams that would run over the end of a document are cut off by its bounds
            out.append(((((h * np.uint32(0x85EBCA6B)) >> np.uint32(13)) & np.uint32(BUCKETS - 1)).astype(np.int64), bounds[:-1], np.maximum(bounds[1:] - (k - 1), bounds[:-1])))
    return out, has


def counts(texts: DataFrame) -> DataFrame:
    """(lang, bucket, n) of texts (text, lang); bucket -1 counts the documents."""

    def fold(batches):
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for part in C.slices(batch, 1 << 20):
                langs = np.array(part.column("lang").to_pylist(), object)
                grams, has = buckets(*C.utf8(part.column("text")))
                for lang in sorted({*langs}):
                    mine = np.flatnonzero((langs == lang) & has)
                    if not len(mine):
                        continue
                    own = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    docs[lang] = docs.get(lang, 0) + len(mine)
                    for bucket, lo, hi in grams:
                        inside = np.zeros(len(bucket) + 1, np.int8)
                        np.add.at(inside, lo[mine], 1)
                        np.add.at(inside, hi[mine], -1)
                        own += np.bincount(bucket[np.cumsum(inside[:-1]) > 0], minlength=BUCKETS)
        for lang, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(own[at], docs[lang]), pa.int64())], names=["lang", "bucket", "n"])

    rows = texts.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    return rows.mapInArrow(C.released(fold), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(texts: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log priors, and log-probabilities (bucket, language). At most languages x BUCKETS counts reach the driver."""
    got = counts(texts).toPandas()
    langs = sorted(got["lang"].unique())
    n = np.zeros((BUCKETS, len(langs)))
    prior = np.zeros(len(langs))
    code = got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)
    bucket, value = got["bucket"].to_numpy(), got["n"].to_numpy()
    n[bucket[bucket >= 0], code[bucket >= 0]] = value[bucket >= 0]
    prior[code[bucket < 0]] = value[bucket < 0]
    logp = np.log((n + SMOOTHING) / (n.sum(0) + SMOOTHING * BUCKETS))
    return langs, np.log(prior / max(prior.sum(), 1)), logp.astype(np.float32)


def scored(data, offs, model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language (-1: none), its tempered probability, and the weight of evidence for it, for the texts of one slice."""
    langs, prior, logp = model
    grams, has = buckets(data, offs)
    ll = np.zeros((len(offs) - 1, len(langs)))
    n = np.zeros(len(offs) - 1)
    if not langs:
        return np.full(len(n), -1), np.zeros(len(n)), np.zeros(len(n))
    by_order = []
    for bucket, lo, hi in grams:
        size = hi - lo
        before = ll.copy()
        for i in np.flatnonzero(size > BUCKETS):  # a long text: its histogram is smaller than its n-grams
            ll[i] += np.bincount(bucket[lo[i] : hi[i]], minlength=BUCKETS) @ logp
        some = np.flatnonzero((size > 0) & (size <= BUCKETS))
        if len(some):
            edges = np.stack([lo[some], hi[some]], 1).ravel()
            values = np.vstack([logp[bucket], np.zeros((1, len(langs)), np.float32)])
            ll[some] += np.add.reduceat(values, np.minimum(edges, len(bucket)), axis=0, dtype=np.float64)[::2]
        n += size
        by_order.append((size, ll - before))
    x = prior + ll / np.sqrt(np.maximum(n, 1))[:, None]
    x = np.exp(x - x.max(1, keepdims=True))
    best = (prior + ll).argmax(1)
    score = x[np.arange(len(x)), best] / x.sum(1)
    # of its own language, by order; a letter's place in an n-gram of random letters is worth its own probability
    at = np.arange(len(x)), best
    share = np.log(len(ORDERS))  # the n-grams of all orders share one distribution
    per_letter = np.where(by_order[0][0] > 0, by_order[0][1][at] / np.maximum(by_order[0][0], 1) + share, 0.0)
    shuffled = sum(size * (k * per_letter - share) for k, (size, _) in zip(ORDERS, by_order, strict=True))
    evidence = ll[at] - np.maximum(shuffled, -n * np.log(BUCKETS))
    return np.where(has, best, -1), np.where(has, score, 0.0), np.where(has, evidence, 0.0)


def predict(docs: DataFrame, model, keep: list[str], words_only: bool = False) -> tuple[DataFrame, list[str]]:
    """Columns keep of docs (under the names given back), then lang_pred, score and evidence; of words only, by NO_WORD, if so wished."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, names = C.numbered(docs, keep)
    if words_only:
        rows = rows.withColumn("text", F.regexp_replace("text", NO_WORD, " "))
    schema = ", ".join([*(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names), "lang_pred string", "score double", "evidence double"])

    def score(batches):
        langs = shared.value[0]
        limit = max(1 << 16, (1 << 21) // max(4, len(langs)))
        for batch in batches:
            for part in C.slices(batch, limit):
                best, value, evidence = scored(*C.utf8(part.column("text")), shared.value)
                pred = pa.array(["und" if b < 0 else langs[b] for b in best], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pred, pa.array(value, pa.float64()), pa.array(evidence, pa.float64())], names=[*names, "lang_pred", "score", "evidence"])

    return rows.mapInArrow(C.released(score), schema), names


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows that aren't held out and have a lang. A null doc_id isn't held out."""
    held = F.coalesce(held_out, F.lit(False))
    model = train(docs.where(~held))
    out, names = predict(docs.select("doc_id", held.alias("held_out"), "text"), model, ["doc_id", "held_out"])
    return out.select(F.col(names[0]).alias("doc_id"), F.col(names[1]).alias("held_out"), "lang_pred", "score")


def op1_language_id(spark, sf_dir) -> DataFrame:
    return identify(C.table(spark, sf_dir, "documents"), C.remainder("doc_id", 4) == 2)


def threshold(labelled: DataFrame, model) -> float:
    """The least evidence of a text that stays: -EVIDENCE, or less if it takes that to keep KEPT of all labelled texts. Of them only their evidence is written."""
    some = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("text")
    judged, _ = predict(some, model, [], words_only=True)
    found = C.written(judged.where("lang_pred != 'und'").select("evidence"))
    spare = int(found.count() * (1 - KEPT))
    least = found.where(F.col("evidence") < -EVIDENCE).orderBy("evidence").offset(spare).first()
    return least[0] if least else -EVIDENCE


def stage_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are in a language that the labels teach. Rejected are those without a letter, and those that the model of their language doesn't explain. A null lang becomes the predicted one; given labels stay.

    Without any labelled document nothing is known of languages, and all documents with a letter stay as they are.
    """
    C.bounded_batches(spark)
    model = train(docs)
    lettered = docs.where(F.coalesce(F.col("`text`").rlike(r"\p{L}"), F.lit(False)))
    if not model[0]:
        return lettered
    least = threshold(docs, model)
    out, names = predict(lettered, model, docs.columns, words_only=True)
    # a text with letters, but without words, says nothing about its language; evidence is 0 there, and it stays
    kept = out.where(F.col("evidence") >= least)
    lang = names[docs.columns.index("lang")]
    return C.renamed(kept.withColumn(lang, F.coalesce(lang, F.nullif("lang_pred", F.lit("und")))), names, docs.columns)
