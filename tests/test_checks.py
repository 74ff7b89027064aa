"""Signatures, task boards, references, packages, experiments."""

import hashlib
import hmac

from pyspark.sql import functions as F

from tallyloom.operators import checks


def test_signature(spark):
    rows = [("héllo",), ("",), ("x" * 300,)]
    for key in (b"k", b"q" * 100):
        for r in spark.createDataFrame(rows, "t string").select("t", checks.signature(F.col("t"), key).alias("s")).collect():
            assert r["s"] == hmac.new(key, r["t"].encode(), hashlib.sha256).hexdigest()


def test_numbers_near(spark):
    got = spark.range(1).select(checks.numbers_near(F.lit("1,200 new articles, 5\narticles and 77 of all the many old articles"), "articles")).first()[0]
    assert got == [1200]


def test_code_is_parsed(spark):
    rows = spark.createDataFrame([("x = 1",), ("def f(:",), (None,)], "c string")
    assert [r[0] for r in rows.select(checks.is_python("c")).collect()] == [True, False, None]


def test_task_board(spark):
    board = "# Board\n## In progress\n- **Ship** the thing\n- **Wait** blocked by review\n## Next\n- **Later** idea\n## Done\n- **Old** one\nplain"
    found = checks.tasks(spark.createDataFrame([("p", board)], "path string, text string"))
    assert [(r["name"], r["status"], r["section"]) for r in found.orderBy("place").collect()] == [("Wait", "BLOCKED", "In progress"), ("Ship", "IN PROGRESS", "In progress"), ("Later", "NEXT", "Next"), ("Old", "DONE", "Done")]
    assert checks.next_action(found).first()[:] == ("p", "Wait", "BLOCKED")


def test_references_and_titles(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(checks.cross_references(F.lit("M1 -> [P1, P2]\n| M2 | P3 |\nM1 -> [P9]\ntext"))) == {"M1": ["P1", "P2"], "M2": ["P3"]}
    kind, artist, year = checks.title_kind(F.lit("Ann Lee – talk (2019)"), [("talk", "(?i)talk"), ("song", "(?i)song")])
    assert (one(kind), one(artist), one(year)) == ("talk", "Ann Lee", 2019)


def test_package(spark):
    sections = [("a", F.lit("aa")), ("b", F.lit("bbbb")), ("c", F.lit("cc"))]
    size = lambda n: spark.range(1).select(checks.package(sections, n, ("b", "c"))).first()[0]
    assert [size(12), size(11), size(6), size(1)] == ["aa\n\nbbbb\n\ncc", "aa\n\ncc", "aa\n\ncc", "aa"]


def test_experiments(spark):
    old = spark.createDataFrame([(1, "running", "h", ["a"]), (2, "archived", "h", []), (3, "running", "h", [])], "id int, status string, hypothesis string, observations array<string>")
    changes = spark.createDataFrame([(1, None, "b", 1), (1, "paused", None, 2), (1, None, "c", 3), (2, "running", "x", 1)], "id int, status string, observation string, at int")
    new = checks.advanced(old, changes)
    assert sorted(map(tuple, new.collect())) == [(1, "paused", "h", ["a", "b", "c"]), (2, "archived", "h", []), (3, "running", "h", [])]
    assert [r["id"] for r in checks.watchlist(new).collect()] == [3]
    assert [r[0] for r in checks.missing(old.select("id"), changes.select("id"), "id").collect()] == [3]
