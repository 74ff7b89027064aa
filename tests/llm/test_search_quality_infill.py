"""Ranked search, the quality classifier, fill-in-middle."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyloom.llm import common as C
from tallyloom.llm import infill, quality, queries, ranked
from tests.test_oracles import TABLES, cells

from .conftest import COLUMNS, DIR, LONG, needs_data

duckdb = pytest.importorskip("duckdb")


def test_row_groups_of_the_index_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ranked, "SEGMENT_BYTES", 1 << 14)
    monkeypatch.setattr(ranked, "ROW_GROUP", 1 << 18)
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(i, " ".join(map(str, rng.integers(0, 1 << 40, 300)))) for i in range(400)], "doc_id long, text string").coalesce(1)
    (file,) = ranked.Index(docs).segments.inputFiles()
    found = pq.ParquetFile(file.removeprefix("file://")).metadata
    groups = [found.row_group(i) for i in range(found.num_row_groups)]
    assert sum(g.num_rows for g in groups) > 90 and max(g.total_byte_size for g in groups) < 2 << 18


@needs_data
@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_fill_in_middle"])
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    assert cells(queries.QUERIES[name](spark, DIR).toPandas()) == cells(db.execute(queries.ORACLES[name]).df())


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, top=ranked.TOP):
    """(item_id, rank, doc_id, score) as the description says, one document after the other."""
    own = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(bool(c) for _, c in own)
    l = sum(sum(c.values()) for _, c in own)
    df = Counter(w for _, c in own for w in c)
    for item, text in items:
        scores = []
        for i, c in own:
            m = 10 + 90 * sum(c.values()) * n // max(l, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in set(terms(text)) if c[w])
            if s > 0:
                scores.append((-s, i is None, i, s))
        for rank, (_, _, i, s) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            yield item, rank, i, s


@pytest.mark.parametrize(("segment", "block"), [(1 << 21, 1 << 18), (64, 8)])
def test_search_against_brute_force(spark, odd, monkeypatch, segment, block):
    """Odd documents and queries, many ties; with small segments and blocks the rows are the same."""
    monkeypatch.setattr(ranked, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", block)
    items = [(1, "the cat and the MOON"), (2, None), (3, ""), (4, "-- ??"), (5, "nowhere"), (6, "wort ñandú É 1234"), (None, "la luna"), (7, "the moon"), (7, "the moon"), (8, LONG)]
    more = spark.createDataFrame([(100 + i, "tie of the same words" + " more" * (i % 3)) for i in range(40)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in [*items, (9, "same words more")]], "item_id long, text string, score string, query int")
    got = ranked.Index(odd.unionByName(more, allowMissingColumns=True)).search(asked).collect()
    want = brute_search([tuple(r) for r in docs.collect()], [*items, (9, "same words more")])
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_search_of_nothing(spark, nothing):
    asked = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert ranked.Index(nothing).search(asked).count() == 0
    docs = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    assert ranked.Index(docs).search(asked.where("false")).count() == 0
    assert [tuple(r) for r in ranked.Index(docs).search(asked).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-3, 3), max_size=60), st.integers(1, 12))
def test_leading_keeps_ties(scores, top):
    s = np.array(scores, np.int64)
    ids = np.arange(len(s))[::-1] * 2
    want = sorted((-x, i) for x, i in zip(scores, ids.tolist(), strict=True) if x > 0)[:top]
    assert [(-s[p], ids[p]) for p in ranked.leading(s, ids, top)] == want


@needs_data
def test_quality_of_held_out_documents(spark):
    sf = DIR.replace("0.001", "0.01")
    got = quality.op12_quality_trees(spark, sf).toPandas()
    both = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = both[both["held_out"]]
    assert len(got) == 1000 and got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == got["predicted"]).all()
    assert (got["held_out"] == got["doc_id"].map(lambda i: crc32(str(i).encode()) % 3 == 1)).all()
    assert len(held) > 100 and (held["predicted"] == held["quality"]).mean() > 0.95
    good, bad = (held[held["quality"] == q]["score"].to_numpy() for q in (1, 0))
    assert np.mean(good[:, None] > bad[None, :]) > 0.97


@needs_data
def test_held_out_labels_are_not_used(spark):
    docs, labels = C.table(spark, DIR, "documents"), C.table(spark, DIR, "labels").select("doc_id", F.col("quality").alias("label"))
    held = C.remainder("doc_id", 3) == 1
    turned = labels.withColumn("label", F.when(held, 1 - F.col("label")).otherwise(F.col("label")))
    assert sorted(map(tuple, quality.scored(docs, labels, held).collect())) == sorted(map(tuple, quality.scored(docs, turned, held).collect()))


def test_flattened_trees_score_as_the_model(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4)).astype(np.float32)
    rows = spark.createDataFrame([([float(v) for v in r], float(r[0] * r[1] > 0.1), 1.0) for r in x], "x array<float>, label double, n double")
    vectors = rows.select(array_to_vector("x").alias("v"), "label", "x")
    model = GBTClassifier(featuresCol="v", labelCol="label", maxIter=7, maxDepth=3, stepSize=0.3, seed=1).fit(vectors)
    want = model.transform(vectors).select("x", vector_to_array("probability")[1].alias("p")).collect()
    got = quality.Forest.flattened(spark, model)(np.array([r["x"] for r in want], np.float32))
    assert np.allclose(got, [r["p"] for r in want], atol=1e-12)


def test_statistics_one_by_one():
    """Plain counts over each text, and the same rows whatever texts stand beside it."""
    texts = ["", "One two two TWO!\none line\none line\n\n### 12", "é \U0001f600 ñandú", " \n ", "a", LONG[:3000]]
    import pyarrow as pa

    got = quality.statistics(*C.utf8(pa.array(texts)))
    for t, row in zip(texts, got, strict=True):
        f = dict(zip(quality.FEATURES, row.tolist(), strict=True))
        words, lines, n = t.split(), [x for x in t.split("\n") if x], max(len(t), 1)
        low = [w.lower() for w in words]
        pairs = list(zip(low, low[1:], strict=False))
        want = {
            "chars": math.log1p(len(t)), "upper_share": sum("A" <= c <= "Z" for c in t) / n, "digit_share": sum(c in "0123456789" for c in t) / n, "symbol_share": t.count("#") / n, "other_share": sum(ord(c) > 127 for c in t) / n,
            "words": math.log1p(len(words)), "distinct_words": len({*low}) / max(len(words), 1), "commonest_word": max(Counter(low).values(), default=0) / max(len(words), 1), "single_words": sum(v == 1 for v in Counter(low).values()) / max(len(words), 1),
            "stutter": sum(a == b for a, b in pairs) / max(len(pairs), 1), "distinct_pairs": len({*pairs}) / max(len(pairs), 1), "word_size": sum(len(w.encode()) for w in words) / max(len(words), 1),
            "shouted_words": sum(w == "TWO!" for w in words) / max(len(words), 1), "lines": math.log1p(len(lines)), "distinct_lines": len({*lines}) / max(len(lines), 1), "commonest_line": max(Counter(lines).values(), default=0) / max(len(lines), 1),
            "repeated_line_bytes": (sum(len(x.encode()) for x in lines) - sum(len(x.encode()) for x in {*lines})) / max(len(t.encode()), 1),
        }
        if t != "a":  # one letter
            want["capital_words"] = sum("A" <= w[0] <= "Z" for w in words) / max(len(words), 1)
        assert all(f[k] == pytest.approx(v, abs=1e-5) for k, v in want.items()), (t[:20], {k: (f[k], v) for k, v in want.items() if abs(f[k] - v) > 1e-5})
        alone = quality.statistics(*C.utf8(pa.array([t])))[0]
        assert np.array_equal(alone, row)


def test_odd_documents_get_a_score(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (6, None), (7, 1), (7, 0), (8, 1), (None, 0), (99, 0)], "doc_id long, label int")
    got = quality.scored(odd, labels, F.col("doc_id") == 9)
    rows = got.collect()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["held_out"]} == {9} and len({r["score"] for r in rows if r["doc_id"] == 7}) == 1
    assert quality.scored(nothing, labels, F.lit(False)).count() == 0
    assert {r["score"] for r in quality.scored(odd, labels.where("label = 1"), F.lit(False)).collect()} == {1.0}
    assert {r["score"] for r in quality.scored(odd, labels.where("false"), F.lit(False)).collect()} == {0.5}


UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tabé\U0001f600<P>", max_size=120), st.integers(1, 5), st.integers(1, 40), st.data())
def test_checkpoints_find_every_cut(text, step, chunk, data):
    raw = np.frombuffer(text.encode(), np.uint8)
    index = infill.Checkpoints(raw, step, chunk)
    units = UNITS.findall(text)
    assert index.units == len(units) and index.chars == len(text)
    k = data.draw(st.integers(0, len(units)))
    before = "".join(units[:k])
    assert index.cut(k) == (len(before.encode()), len(before))


def test_checkpoints_are_sparse():
    raw = np.frombuffer(LONG.encode(), np.uint8)
    index = infill.Checkpoints(raw)
    assert len(index.bytes_at) == index.units // infill.STEP + 1


def brute_infill(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_against_brute_force(spark, odd):
    more = [(1000 + i, t) for i in range(40) for t in ("a b c d <", " x\ty ", "holds <P> a mark", "> S> ñ é \U0001f600\n\n", LONG[-1000:])]
    docs = odd.select("doc_id", "text").collect() + more
    rows = infill.transformed(odd.unionByName(spark.createDataFrame([(*r, None, None, 0) for r in more], COLUMNS), allowMissingColumns=True))
    got = rows.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((brute_infill(*r) for r in docs), key=key)
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in docs) and {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_infill_of_nothing(nothing):
    assert infill.transformed(nothing).count() == 0
