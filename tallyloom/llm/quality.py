"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened for vectorised traversal.

Each text is reduced to FEATURES once, in one pass; those rows are a written table. Spark's boosted trees (splits are
chosen over histograms of at most BINS bins a feature) learn from labelled rows. The ensemble is then flattened into
arrays over all nodes of all trees (feature, threshold, left, right, value), where a leaf points to itself, so a task
scores a block of rows by DEPTH look-ups in those arrays, whatever paths the rows take.

Learned from are at most about TRAIN_ROWS distinct (statistics, label) rows, chosen by hash among the labelled documents
that aren't held out; each weighs as many documents as have it. All documents are scored.

Defined results: a null text counts as empty, its statistics are 0, and it gets a score like any other; a label that is
null isn't learned from; of several labels of a document the more frequent one counts, a tie as 1; with labels of one
kind only the score is that label, without any 0.5, for all; rows that repeat get equal results; an empty table gives no
rows; a very long text is handled whole, in memory of about 60 times its bytes; other columns aren't read, whatever
their names.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Distinct labelled rows that the trees learn from, at most (about).
TRAIN_ROWS = 20_000
#: Each split looks at a random part of the statistics, so that trees lean on several even where one would do.
TREES, DEPTH, BINS, STEP_SIZE, SUBSET = 30, 4, 64, 0.2, "onethird"
#: Rows that are scored at once.
BLOCK = 4096

_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A), "space": (0x20, *range(0x09, 0x0E)),
    "stop": b".,;:'\"()-", "shout": b"!?", "symbol": b"#$%&*+/<=>@[\\]^_`{|}~", "control": (*range(0x09), *range(0x0E, 0x20), 0x7F), "other": range(0xC0, 0x100),
}
FEATURES = (
    "chars", *(f"{c}_share" for c in _CLASSES), "words", "word_size", "word_size_spread", "long_words", "distinct_words", "commonest_word", "single_words", "distinct_pairs", "stutter",
    "capital_words", "shouted_words", "odd_words", "entropy", "lines", "line_size", "distinct_lines", "commonest_line", "repeated_line_bytes",
)
_MASKS = {name: np.isin(np.arange(256), list(members)) for name, members in _CLASSES.items()}
#: Bytes of a line: all but line feed and carriage return.
_LINE = ~np.isin(np.arange(256), [0x0A, 0x0D])


def repeats(group: np.ndarray, key: np.ndarray, n_groups: int, size: np.ndarray | None = None):
    """By group: distinct keys, the most of one key, keys that stand once, and the sum of size over all but a key's first place."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(g)))
    of = g[at]
    most = np.zeros(n_groups)
    np.maximum.at(most, of, run)
    again = np.bincount(g[~new], size[order][~new], n_groups) if size is not None else None
    return np.bincount(of, minlength=n_groups), most, np.bincount(of[run == 1], minlength=n_groups), again


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """FEATURES of each text of a slice, as (text, feature)."""
    n = len(offs) - 1

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[offs[1:]] - total[offs[:-1]]).astype(float)

    out: dict[str, np.ndarray] = {}
    chars = within((data & 0xC0) != 0x80)
    some = np.maximum(chars, 1)
    out["chars"] = np.log1p(chars)
    for name, mask in _MASKS.items():
        out[f"{name}_share"] = within(mask[data]) / some
    doc_of = np.repeat(np.arange(n), np.diff(offs))
    count = np.bincount(doc_of * 256 + data, minlength=256 * n).reshape(n, 256)
    share = count / np.maximum(count.sum(1, keepdims=True), 1)
    out["entropy"] = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)

    starts, ends, doc = C.spans(data, offs, C.NOT_SPACE)
    size = (ends - starts).astype(float)
    words = np.bincount(doc, minlength=n).astype(float)
    total = np.maximum(words, 1)
    mean = np.bincount(doc, size, n) / total
    h = C.word_hashes(C.LOWER[data], starts, ends) if len(starts) else np.empty(0, np.uint64)
    distinct, most, single, _ = repeats(doc, h, n)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    pairs = C.mix(h[pair] * C.BASE + h[pair + 1])
    distinct_pairs = repeats(doc[pair], pairs, n)[0]
    upper = np.concatenate([[0], np.cumsum(_MASKS["upper"][data])])
    letter = np.concatenate([[0], np.cumsum((_MASKS["upper"] | _MASKS["lower"] | (np.arange(256) >= 0x80))[data])])
    plain = np.concatenate([[0], np.cumsum((_MASKS["symbol"] | _MASKS["control"])[data])])
    uppers, letters = upper[ends] - upper[starts], letter[ends] - letter[starts]
    of = lambda flags: np.bincount(doc[flags], minlength=n) / total
    out["words"], out["word_size"] = np.log1p(words), mean
    out["word_size_spread"] = np.sqrt(np.maximum(np.bincount(doc, size * size, n) / total - mean * mean, 0))
    out["long_words"], out["distinct_words"], out["commonest_word"], out["single_words"] = of(size > 20), distinct / total, most / total, single / total
    pairs_of = np.maximum(np.bincount(doc[pair], minlength=n), 1)
    out["distinct_pairs"], out["stutter"] = distinct_pairs / pairs_of, np.bincount(doc[pair], h[pair] == h[pair + 1], n) / pairs_of
    out["capital_words"] = of(_MASKS["upper"][data[starts]]) if len(starts) else np.zeros(n)
    out["shouted_words"] = of((uppers > 1) & (uppers == letters))
    out["odd_words"] = of((letters == 0) | (plain[ends] > plain[starts]))

    starts, ends, doc = C.spans(data, offs, _LINE)
    size = (ends - starts).astype(float)
    lines = np.bincount(doc, minlength=n).astype(float)
    total = np.maximum(lines, 1)
    h = C.word_hashes(data, starts, ends) if len(starts) else np.empty(0, np.uint64)
    distinct, most, _, again = repeats(doc, h, n, size)
    out["lines"], out["line_size"] = np.log1p(lines), np.bincount(doc, size, n) / total
    out["distinct_lines"], out["commonest_line"], out["repeated_line_bytes"] = distinct / total, most / total, again / np.maximum(np.diff(offs), 1)
    return np.stack([out[f] for f in FEATURES], 1).astype(np.float32)


def measured(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, x (FEATURES) of every row of docs, as a written table. A null doc_id isn't held out."""
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")

    def run(batches):
        for batch in batches:
            for part in C.slices(batch, 1 << 20):
                x = statistics(*C.utf8(part.column("text")))
                offsets = np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.ListArray.from_arrays(offsets, x.ravel())], names=["doc_id", "held_out", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return C.written(rows.mapInArrow(C.released(run), f"doc_id {kind}, held_out boolean, x array<float>"))


def taught(rows: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """x, label, n: distinct labelled rows to learn from, and how many documents have each, as a written table. labels: doc_id, label."""
    share = lambda x, n: F.pmod(F.xxhash64(x), F.lit(1 << 20)) < int((1 << 20) * min(1.0, train_rows / max(n, 1)))
    labels = labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = labels.agg(F.approx_count_distinct("doc_id")).first()[0]
    some = labels.where(share("doc_id", known)).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    matched = C.looked_up(rows.where("NOT held_out").select("doc_id", "x"), C.written(some), "doc_id", F.col("x"))
    distinct = C.written(matched.groupBy("x", "label").agg(F.count("*").cast("double").alias("n")))
    return distinct.where(share("x", distinct.count()))


class Forest:
    """Boosted trees as arrays over all nodes; roots says where each tree begins. The score is 1 / (1 + exp(-2 * sum of the leaves' values))."""

    def __init__(self, roots=(), feature=(), threshold=(), left=(), right=(), value=(), depth: int = 0, constant: float = 0.5):
        self.roots, self.feature, self.left, self.right = (np.array(x, np.int64) for x in (roots, feature, left, right))
        self.threshold, self.value, self.depth, self.constant = np.array(threshold, float), np.array(value, float), depth, constant

    @classmethod
    def fit(cls, rows: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Forest:
        """rows: x, label, n."""
        seen = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
        if len(seen) < 2:
            return cls(constant=next(iter(seen), 0.5))
        vectors = rows.select(array_to_vector("x").alias("v"), "label", "n")
        model = GBTClassifier(featuresCol="v", labelCol="label", weightCol="n", maxIter=trees, maxDepth=depth, maxBins=BINS, stepSize=STEP_SIZE, featureSubsetStrategy=SUBSET, seed=7).fit(vectors)
        return cls.flattened(rows.sparkSession, model)

    @classmethod
    def flattened(cls, spark: SparkSession, model) -> Forest:
        """The nodes of a model, as Spark saves them: at most trees x 2^(depth + 1) rows."""
        path = f"{C.shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
        model.save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
        nodes.sort(key=lambda r: (r["treeID"], r["id"]))
        at = {(r["treeID"], r["id"]): i for i, r in enumerate(nodes)}
        leaf = [r["leftChild"] < 0 for r in nodes]
        child = lambda r, i, side: i if leaf[i] else at[r["treeID"], r[side]]
        return cls(
            roots=[at[t, 0] for t in range(len(model.trees))],
            feature=[max(r["split"]["featureIndex"], 0) for r in nodes],
            threshold=[0.0 if end else r["split"]["leftCategoriesOrThreshold"][0] for r, end in zip(nodes, leaf, strict=True)],
            left=[child(r, i, "leftChild") for i, r in enumerate(nodes)],
            right=[child(r, i, "rightChild") for i, r in enumerate(nodes)],
            value=[r["prediction"] * model.treeWeights[r["treeID"]] if end else 0.0 for r, end in zip(nodes, leaf, strict=True)],
            depth=max(t.depth for t in model.trees),
        )

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows (row, feature)."""
        if not len(self.roots):
            return np.full(len(x), self.constant)
        out = np.empty(len(x))
        for lo in range(0, len(x), BLOCK):
            part = x[lo : lo + BLOCK]
            row = np.arange(len(part))[:, None]
            at = np.repeat(self.roots[None, :], len(part), 0)
            for _ in range(self.depth):
                at = np.where(part[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[lo : lo + BLOCK] = 1 / (1 + np.exp(-2 * self.value[at].sum(1)))
        return out


def scored(docs: DataFrame, labels: DataFrame, held_out: Column, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs (doc_id, text). labels: doc_id, label (0 or 1); those of held out rows aren't learned from."""
    rows = measured(docs, held_out)
    forest = rows.sparkSession.sparkContext.broadcast(Forest.fit(taught(rows, labels, train_rows)))

    def run(batches):
        for batch in batches:
            x = batch.column("x")
            score = forest.value(x.flatten().to_numpy().reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(C.released(run), f"doc_id {kind}, held_out boolean, score double, predicted int")


def op12_quality_trees(spark, sf_dir) -> DataFrame:
    labels = C.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return scored(C.table(spark, sf_dir, "documents"), labels, C.remainder("doc_id", 3) == 1)
