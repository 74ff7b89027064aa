"""The inverted index and joins by containment, against plain loops; what their plans read."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import containment as N
from tallyloom.operators import fulltext as T

WORDS = "the cat sat on a mat and then the other cat saß älter été ete thing theory über 12 x1".split()


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "!?", "-"]) for _ in range(rng.randint(0, 40))) for _ in range(150)] + [None, "", "The CAT. Sat; on!", "the " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = T.Index(spark, str(tmp_path_factory.mktemp("index")))
    index.add(docs.where("doc_id % 3 = 0")).add(docs.where("doc_id % 3 <> 0"))  # in two loads
    return index, docs, [plain(t) for t in texts]


def plain(text):
    bare = "".join(c for c in unicodedata.normalize("NFD", (text or "").lower()) if not unicodedata.combining(c))
    return re.findall(r"[^\W_]+", bare)


def holds(q, w):
    if isinstance(q, T.Pair):
        a, b = holds(q.a, w), holds(q.b, w)
        return {"both": a and b, "either": a or b, "without": a and not b}[q.kind]
    if q.distance is not None:
        return any(x == q.words[0] and q.words[1] in w[max(0, i - q.distance - 1) : i] + w[i + 1 : i + q.distance + 2] for i, x in enumerate(w))
    k = len(q.words)
    return any((w[i : i + k - 1] == list(q.words[:-1])) and (w[i + k - 1].startswith(q.words[-1]) if q.open_end else w[i + k - 1] == q.words[-1]) for i in range(len(w) - k + 1))


QUERIES = [
    T.word("cat"), T.word("ÉTÉ"), T.word("nowhere"), T.prefix("th"), T.prefix("zz"), T.phrase("the other cat"), T.phrase("cat sat on th*"), T.phrase("then the the"), T.near("cat", "mat", 0), T.near("cat", "mat", 4), T.near("the", "the", 2),
    T.both(T.word("uber"), T.word("alter")), T.either(T.phrase("the cat"), T.prefix("theo")), T.without(T.word("the"), T.word("cat")), T.without(T.both(T.word("on"), T.prefix("x")), T.either(T.word("12"), T.near("a", "and", 1))),
]


@pytest.mark.parametrize("query", QUERIES, ids=str)
def test_matches_as_a_plain_search(corpus, query):
    index, _, words = corpus
    assert sorted(r["doc"] for r in index.match(query).collect()) == [i for i, w in enumerate(words) if holds(query, w)]


def test_queries_read_postings_of_their_terms_only(corpus):
    index, _, _ = corpus
    plan = plan_of(index.match(T.phrase("the cat")))
    assert plan.count("FileScan") == 1 and "postings" in plan and re.search(r"PartitionFilters: \[(isnotnull\(shard#\d+\), )?\(?shard#\d+ (IN|=) ", plan) and "PushedFilters: [In(term, [cat,the])]" in plan
    assert "StringStartsWith(term,th)" in plan_of(index.match(T.prefix("th")))


def test_a_common_word_is_dealt_over_files(spark, tmp_path):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("same words").alias("text"))
    index = T.Index(spark, str(tmp_path / "i")).add(docs)
    files = index.postings().where("term = 'same'").select(F.col("_metadata.file_path").alias("f")).groupBy("f").count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 250


def test_a_large_load_is_dealt_over_more_tasks_in_slices(spark, corpus, tmp_path, monkeypatch):
    """Memory of a task doesn't grow with the load: words inverted at once, and words that a task sorts."""
    _, docs, words = corpus
    monkeypatch.setattr(T, "TASK_WORDS", 10)
    monkeypatch.setattr(T, "SLICE_WORDS", 16)
    index = T.Index(spark, str(tmp_path / "i")).add(docs)
    files = index.postings().where("term = 'the'").select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert files > 2 * T.SALT
    assert sorted(r["doc"] for r in index.match(T.phrase("the other cat")).collect()) == [i for i, w in enumerate(words) if holds(T.phrase("the other cat"), w)]
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/i/sizes").select("docs", "words").collect()] == [(len(words), sum(map(len, words)))]
    got = {(r["doc"], r["term"]): sorted(r["positions"]) for r in index.postings().collect()}
    assert got == {(i, t): [k for k, x in enumerate(w) if x == t] for i, w in enumerate(words) for t in w}


def test_ranks(corpus):
    index, docs, words = corpus
    import math

    q = T.either(T.word("cat"), T.phrase("the other"))
    n, mean = len(words), sum(map(len, words)) / len(words)
    tf = [(w.count("cat"), sum(w[i : i + 2] == ["the", "other"] for i in range(len(w)))) for w in words]
    df = [sum(t[k] > 0 for t in tf) for k in (0, 1)]
    idf = [max(math.log((n - d + 0.5) / (d + 0.5)), 0) or 1e-6 for d in df]
    score = {i: sum(idf[k] * t[k] * 2.2 / (t[k] + 1.2 * (0.25 + 0.75 * len(w) / mean)) for k in (0, 1)) for i, (t, w) in enumerate(zip(tf, words, strict=True)) if any(t)}
    want = sorted(score, key=lambda i: (-round(score[i], 9), i))[:20]
    got = index.ranked(q).collect()
    assert [r["doc"] for r in got] == want and all(r["score"] == pytest.approx(score[r["doc"]]) for r in got)
    even = index.ranked(q, docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("doc"))).collect()
    assert [r["doc"] for r in even] == [i for i in sorted(score, key=lambda i: (-round(score[i], 9), i)) if i % 2 == 0][:20]


def test_an_empty_index(spark, tmp_path):
    index = T.Index(spark, str(tmp_path / "i")).add(spark.createDataFrame([], "doc_id long, text string"))
    index.add(spark.createDataFrame([(1, None), (None, "word"), (2, "word")], "doc_id long, text string"))
    assert [r["doc"] for r in index.match(T.word("word")).collect()] == [2] and len(index.ranked(T.word("word")).collect()) == 1


def test_bad_words_are_refused():
    for bad in ("", "two words", "a-b", "*"):
        with pytest.raises(ValueError, match="not one word"):
            T.word(bad)


def test_containment_against_all_pairs(spark):
    rng = random.Random(9)
    part = lambda lo, hi: "".join(rng.choice("abé😀.*") for _ in range(rng.randint(lo, hi)))
    keys = [part(0, 25) for _ in range(300)] + ["", "aaaaaaaaaaaa", "aaaaaaaaaaaa"]
    names = [part(0, 7) for _ in range(120)] + [k[3:11] for k in keys[:60]] + ["aaaaaa", "", "nowhere to be found"]
    n, k = (spark.createDataFrame([(x,) for x in v] + [(None,)], f"{c} string") for v, c in ((names, "name"), (keys, "key")))
    got = sorted(tuple(r) for r in N.contained(n, k).collect())
    assert got == sorted((a, b) for a in {*names} - {""} for b in {*keys} - {""} if a in b) and len(got) > 500
    assert sorted(tuple(r) for r in N.as_suffix(n, k).collect()) == sorted((a, b) for a in {*names} - {""} for b in {*keys} if b.endswith(a))
    for df in (N.contained(n, k), N.as_suffix(n, k)):
        assert not re.search("CartesianProduct|BroadcastNestedLoop", plan_of(df))


def test_first_weights(spark):
    songs = spark.createDataFrame([("x/one.md", 2, 0.5), ("x/one.md-live", 1, 0.7), ("two-analysis.md", 3, 1.5)], "key string, place long, weight double")
    files = spark.createDataFrame([("one.md",), ("two.md",), ("three.md",)], "file string")
    assert {r["file"]: r["weight"] for r in N.first_weights(files, songs).collect()} == {"one.md": 0.7, "two.md": 1.5, "three.md": 1.0}
