"""Fingerprints, the Jaccard join, decontamination."""

import random
import re
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from tallyloom.llm import common as C
from tallyloom.llm import decontam, editprint, ngramjoin
from tallyloom.llm.components import components as components_of

from .conftest import DIR, needs_data


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def near_copies(n, seed=3):
    """Chains and stars of near copies of several texts, with shared passages, and texts on their own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 5)))
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(n):
        base = [word() for _ in range(rng.randint(30, 90))] + (passage if rng.random() < 0.4 else [])
        now = base
        for k in range(rng.randint(1, 9)):
            out.append(" ".join(now))
            now = list(base if k % 2 else now)
            for _ in range(rng.randint(0, 2)):
                now[rng.randrange(len(now))] = word()
    rng.shuffle(out)
    return list(enumerate(out, start=100))


def components(docs):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = sorted((find(ids[a]), find(ids[b])))
                root[q] = p
    return {i: (i, len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("rounds", "region", "broadcast"), [(1, 2, 0), (2, 256, 200_000)])
def test_join_against_all_pairs(spark, monkeypatch, rounds, region, broadcast):
    monkeypatch.setattr(ngramjoin, "ROUNDS", rounds)
    monkeypatch.setattr(ngramjoin, "REGION", region)
    monkeypatch.setattr(C, "BROADCAST_ROWS", broadcast)
    docs = near_copies(60)
    got = ngramjoin.joined(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(components(docs).values())


def test_join_of_odd_documents(spark, odd, nothing):
    got = {r["doc_id"]: tuple(r) for r in ngramjoin.joined(odd).collect()}
    assert ngramjoin.joined(nothing).count() == 0
    assert [got[i][2] for i in (1, 2, 3, 4, 5, 7)] == [1, 2, 3, 4, 5, 1]
    assert [got[i][1] for i in (2, 3, 4, 5, 11)] == [0, 0, 0, 1, 1] or got[5][1] >= 1
    kept = ngramjoin.stage_near_duplicates(spark, odd, "")
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert 7 not in ids and ids.count(1) == 1 and {2, 3, 4, 5, 6, 8, 9, 11} <= set(ids)


def test_stage_takes_five_words_and_four_fifths(spark):
    words = lambda k, n=50: [f"w{k}x{j}" for j in range(n)]
    swapped = [*words(1)[:25], "other", *words(1)[26:]]  # similarity 0.804 of five words, 0.843 under four
    docs = [(1, words(1)), (2, swapped), (3, words(3)), (3, words(4)), (5, words(5)), (4, words(5)), (None, words(5)), (None, words(6))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"] or 0, r["text"].split("x")[0]) for r in ngramjoin.stage_near_duplicates(spark, docs, "").collect())
    assert got == [(0, "w6"), (1, "w1"), (3, "w3"), (3, "w4"), (4, "w5")]
    assert len({r["component_id"] for r in ngramjoin.joined(docs.where("doc_id < 3")).collect()}) == 2


def test_components(spark):
    links = lambda rows: components_of(spark.createDataFrame(rows, "a long, b long"))
    assert links([]).count() == 0
    chain = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (40, 40), (None, 3), (5, None)]
    got = {r["node"]: r["label"] for r in links(chain).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 30: 30, 31: 30, 40: 40}


@needs_data
def test_join_against_sql(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    want = sorted(c.execute(f"SELECT doc_id, n_shingles, component_id FROM ({ngramjoin.ORACLE})").fetchall())
    assert sorted(map(tuple, ngramjoin.op8_ngram_jaccard(spark, DIR).collect())) == want


def windows(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contaminated(docs, items):
    for i, t in docs:
        w, hit, names = windows(t), set(), set()
        for k, x in items:
            v = windows(x)
            n = min(10, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[a : a + n]:
                        hit |= set(range(p, p + n))
                        names.add(str(k))
        yield i, len(w), len(hit), len(names), sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_decontamination_against_brute_force(spark, folder, monkeypatch, broadcast):
    monkeypatch.setattr(C, "BROADCAST_ROWS", broadcast)
    items = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (10, "x"), (3, ""), (4, None), (5, "one two three four five six seven eight nine ten"), (6, "a a a a a a a a a a a a")]
    docs = [(1, "zero One two, three four five six seven eight nine ten eleven"), (2, "a short item here, short-item"), (3, None), (4, ""), (5, "one two three four five six seven eight nine"), (6, "a " * 30), (7, "X y x"), (8, "ein x é x"), (9, "short"), (9, "short item")]
    sf = folder(documents=spark.createDataFrame(docs, "doc_id long, text string"), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = decontam.op6_benchmark_decontamination(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(contaminated(docs, items))


def test_repeated_items_count_once(spark, folder):
    text = "one two three four five six seven eight nine ten eleven"
    items = [(1, text), (1, text), (1, "a b c"), (2, text + " twelve"), (None, "a b c")]
    docs = [(1, f"x {text} twelve y"), (2, "a b c"), (3, "b c")]
    sf = folder(documents=spark.createDataFrame(docs, "doc_id long, text string"), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = {r["doc_id"]: r for r in decontam.op6_benchmark_decontamination(spark, sf).collect()}
    assert [(got[i]["n_hit"], got[i]["n_items"]) for i in (1, 2, 3)] == [(12, 2), (3, 2), (0, 0)]
    assert got[1]["items_sha256"] == sha256(b"1,2").hexdigest() and got[2]["items_sha256"] == sha256(b"1").hexdigest()
    known = [r for r in items if r[0] is not None]
    c = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", known, "item_id")):
        c.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        c.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    sf = folder(**{"k/documents": spark.createDataFrame(docs, "doc_id long, text string"), "k/benchmark": spark.createDataFrame(known, "item_id long, text string")})
    assert sorted(map(tuple, decontam.op6_benchmark_decontamination(spark, f"{sf}/k").collect())) == sorted(c.execute(decontam.ORACLE).fetchall())


def test_decontamination_of_odd_tables(spark, folder, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    sf = folder(benchmark=none, documents=odd.drop("odd.name"))
    assert not any(r["contaminated"] for r in decontam.op6_benchmark_decontamination(spark, sf).collect())
    kept = decontam.stage_decontaminate(spark, odd, sf)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert decontam.stage_decontaminate(spark, nothing, sf).count() == 0


def edited(texts):
    for k, t in enumerate(texts):
        m = len(t) // 4
        yield t[: len(t) - m] + texts[(k + 1) % len(texts)][:m]


@needs_data
def test_fingerprints(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in editprint.op3_edit_fingerprints(spark, DIR).collect()}
    assert len(got) == len(docs)
    by_text = {}
    for (i, t), e in zip(docs, edited([t for _, t in docs]), strict=True):
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == sha256(e.encode()).hexdigest()
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    long = [r for r in got.values() if r["n_chars"] > 200]
    assert min(r["near_edited"] for r in long) > 0.6 and sum(r["near_next"] for r in long) / len(long) < 0.3
    # the edited text's fingerprint is that of the text itself
    texts = list(edited([t for _, t in docs]))
    own = {r["doc_id"]: r["fingerprint"] for r in editprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(own[k] == got[i]["edited_fingerprint"] for k, (i, _) in enumerate(docs))


def test_fingerprints_follow_edit_distance():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    prints = {}
    for share in (0.0, 0.01, 0.05):
        t = list(text)
        for _ in range(int(share * len(t))):
            at = rng.randrange(len(t))
            t[at : at + rng.choice((0, 1))] = rng.choice(("", "q"))
        prints[share] = next(editprint.described(["".join(t)], [""]))[1]
    other = next(editprint.described(["".join(rng.choice("abcdefghij ") for _ in range(3000))], [""]))[1]
    near = [editprint.likeness(prints[0.0], x) for x in (prints[0.0], prints[0.01], prints[0.05], other)]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] > near[3] and near[3] < 0.3


def test_fingerprints_of_odd_documents(spark, odd, nothing):
    assert editprint.with_next(nothing).count() == 0
    got = editprint.with_next(odd).collect()
    assert len(got) == odd.count()
    order = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in odd.collect()))
    want = sorted(sha256(e.encode()).hexdigest() for e in edited([t for *_, t in order]))
    assert sorted(r["edited_sha256"] for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    one = editprint.with_next(odd.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def plain_embedding(text):
    """The walk as its description says, a step at a time."""
    out, i, j = [], 0, 0
    while i < len(text):
        out.append(text[i])
        kind = int(editprint.kinds_and_digits(np.array([ord(text[i])], np.uint32))[0][0])
        x = (j % editprint.PERIOD) * editprint.KINDS + kind + 1
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
            x = ((x ^ (x >> shift)) * factor) & (1 << 64) - 1
        i += (x >> 40) & 1
        j += 1
    return out


def test_fingerprints_against_a_plain_walk():
    rng = random.Random(2)
    for n in (1, 7, 130, 300, 1500):
        text = "".join(rng.choice("abcdefghij \u00e9\U0001f600") for _ in range(n))
        shown = plain_embedding(text)
        level = editprint.level_of(n)
        kept = [j for j in range(len(shown)) if editprint.levels(len(shown))[j] >= level]
        digit = [int(editprint.kinds_and_digits(np.array([ord(shown[j])], np.uint32))[1][0]) for j in kept]
        assert next(editprint.described([text], [""]))[1] == f"{level:x}:" + "".join(f"{d:x}" for d in digit)


def test_search_finds_edited_texts(spark):
    rng = random.Random(5)
    letters = "eeeettaaooiinnsshhrrdlcumwfgypb      "
    docs = [(i, "".join(rng.choice(letters) for _ in range(rng.choice((150, 400, 2000))))) for i in range(60)]
    near, kind_of = [], {}
    for i, t in docs[:45]:
        m = len(t) // 10
        for k, kind in enumerate(("start", "middle", "end", "spread")):
            at = {"start": range(m), "middle": range(len(t) // 2, len(t) // 2 + m), "end": range(len(t) - m, len(t)), "spread": rng.sample(range(len(t)), m)}[kind]
            new = list(t)
            for x in at:
                new[x] = rng.choice((rng.choice(letters), rng.choice(letters), "", rng.choice(letters) * 2))
            near.append((1000 * (k + 1) + i, "".join(new)))
            kind_of[i, 1000 * (k + 1) + i] = kind
    rows = lambda x: spark.createDataFrame(x, "doc_id long, text string")
    copies = [(9000 + k, docs[50][1]) for k in range(300)]
    got = {(r["query_id"], r["doc_id"]) for r in editprint.search(rows(docs), rows(docs + near + copies + [(9999, None)])).collect()}
    for kind in ("start", "middle", "end", "spread"):
        want = {p for p, k in kind_of.items() if k == kind}
        assert len(want & got) >= 0.9 * len(want), (kind, len(want & got), len(want))
    assert {d for q, d in got if q == 50} == {d for d, _ in copies}
    assert all((d % 1000 == q and d < 9000) or (q == 50 and d >= 9000) for q, d in got)
