"""Articles as files, skills, sessions' files, aliases, expansion."""

from pyspark.sql import functions as F

from tallyloom.operators import extraction, texts
from tallyloom.sources import articles
from tallyloom.sources import library as L

ROWS = [(7, "A Title: with (marks)!", "Ann", "2024-01-02", "http://x/1", "s", "Body one.\n\n---\nmore"), (12345, " ", None, None, None, "s", None), (1, "Ü b", "", "2024-01-01", "u", "t", "two words")]
SCHEMA = "id long, title string, author string, date string, url string, source string, body string"


def test_articles_are_read_as_they_were_written(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    files = {r["name"]: r for r in L.article_files(rows).collect()}
    assert sorted(files) == ["001-ü-b.md", "007-a-title-with-marks.md", "12345-untitled.md"]
    read = articles.parsed(spark.createDataFrame([(n, r["text"]) for n, r in files.items()], "path string, text string"))
    got = {r["path"]: (r["title"], r["author"], r["date"], r["url"], r["body"], r["words"]) for r in read.collect()}
    assert got["007-a-title-with-marks.md"] == ("A Title: with (marks)!", "Ann", "2024-01-02", "http://x/1", "Body one.\n\n---\nmore", 4)
    assert got["12345-untitled.md"][:3] == ("Untitled", "Unknown", "Unknown") and files["12345-untitled.md"]["words"] == 0
    L.save(rows, str(tmp_path / "lib"))
    L.save(rows, str(tmp_path / "lib"))  # again: replaced, not doubled
    index = spark.read.json(str(tmp_path / "lib/index")).where("source = 's'").orderBy("place").collect()
    assert [r["line"] for r in index] == ["- [A Title: with (marks)!](http://x/1)", "- [Untitled]()"]
    meta = {r["source"]: r for r in spark.read.json(str(tmp_path / "lib/metadata")).collect()}
    assert meta["s"]["articles"] == 2 and meta["s"]["empty"] == 1 and meta["s"]["words"] == 4 and meta["t"]["first"] == "2024-01-01"
    assert spark.read.json(str(tmp_path / "lib/articles")).count() == 3


def test_skills_without_a_description(spark):
    files = [("/k/a/SKILL.md", "---\ndescription: 'Does a'\ncategory: x\n---\nUse when b"), ("/k/b/SKILL.md", "---\nname: b\n---\n# B\n\nUse when\nyou can.\n\nElse"), ("/k/c/SKILL.md", "# C\nUse this always"), ("/k/d/SKILL.md", "nothing"), ("/k/e/SKILL.md", None)]
    got = {r["name"]: (r["description"], r["category"]) for r in L.skills(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["a"] == ("Does a", "x") and got["b"] == ("Use when you can.", "") and got["c"] == ("Use this always", "") and got["d"] == ("", "") and not got["e"][0]


def test_files_of_a_session(spark):
    rows = [("p", "tool", "Write", "/a", False), ("p", "tool", "Edit", "/a", False), ("p", "tool", "Edit", "/b", False), ("p", "tool", "Read", "/c", False), ("p", "result", None, None, True), ("q", "text", None, None, False)]
    got = {r["path"]: tuple(r)[1:] for r in L.session_files(spark.createDataFrame(rows, "path string, kind string, name string, target string, error boolean")).collect()}
    assert got == {"p": (4, 3, 1, ["/a"], ["/b"]), "q": (0, 0, 0, [], [])}


def test_aliases(spark):
    aliases = spark.createDataFrame([("ann", "Ann Lee"), ("al", "Zed"), ("AL", "Abe"), (None, "Max")], "alias string, canonical string")
    rows = spark.createDataFrame([(i, x) for i, x in enumerate([" ANN ", "ann lee", "al", "max", "who", None])], "id int, name string")
    got = {r["id"]: r["canonical"] for r in L.canonical(rows, aliases, "name").collect()}
    assert got == {0: "Ann Lee", 1: "Ann Lee", 2: "Abe", 3: "Max", 4: None, 5: None}


def test_expansion_of_many_queries(spark):
    queries = spark.createDataFrame([(1, "Running  cats run"), (2, ""), (3, None)], "id int, text string")
    synonyms = spark.createDataFrame([("cats", "big felines run"), ("CATS", "lions")], "word string, synonym string")
    got = {(r["id"], r["word"]): r["weight"] for r in L.expanded(queries, synonyms, texts.stemmed).collect()}
    assert got == {(1, "running"): 1.0, (1, "cats"): 1.0, (1, "run"): 1.0, (1, "cat"): 0.7, (1, "big"): 0.5, (1, "felines"): 0.5, (1, "lions"): 0.5}


def test_all_topics(spark):
    rows = spark.createDataFrame([(f"the {i}",) for i in range(9)] + [("none",)], "topic string")
    assert extraction.topics(rows, ("the",), top=None).count() == 9 and extraction.topics(rows, ("the",)).count() == 3
    assert extraction.topics(rows, ("the",), top=None).agg(F.max("score")).first()[0] == 1
