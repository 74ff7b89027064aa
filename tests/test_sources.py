"""Readers and writers on small files, and streams on the event table."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import articles, config, html, logs, sinks, subtitles
from tallyloom.streaming import streams


def files(tmp_path, **texts):
    for name, text in texts.items():
        path = tmp_path / name.replace("__", "/").replace("_md", ".md")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_articles(spark, tmp_path):
    where = files(
        tmp_path,
        kb1__articles__one_md='---\ntitle: "One: two"\nauthor: Ann\ntags: [a, "b c"]\nlevel: 3\n---\n\nBody of one.',
        kb1__articles__two_md="# Two\n**Author:** Bob\n**Date:** 2024-01-02\n\n---\nBody two here.",
        kb2__articles__three_md="---\ntitle: open\nno end",
        kb2__articles__README_md="# no",
        kb2__articles__four_md="# Heading\nplain",
    )
    rows = articles.parsed(articles.read(spark, where)).withColumn("name", F.regexp_extract("path", "([^/]+)[.]md$", 1))
    got = {r["name"]: r for r in rows.collect()}
    assert sorted(got) == ["four", "one", "three", "two"]
    assert (got["one"]["title"], got["one"]["author"], got["one"]["tags"], json.loads(got["one"]["extras"]), got["one"]["body"]) == ("One: two", "Ann", ["a", "b c"], {"level": "3"}, "Body of one.")
    assert (got["two"]["title"], got["two"]["author"], got["two"]["date"], got["two"]["words"]) == ("Two", "Bob", "2024-01-02", 3)
    assert (got["three"]["title"], got["three"]["author"]) == ("Untitled", "Unknown")
    keys = articles.read(spark, where).select(articles.source_key(F.col("path")).alias("k"), articles.title_of(F.col("text"), F.col("path")).alias("t")).collect()
    assert {(r["k"], r["t"]) for r in keys} >= {("kb1", "One: two"), ("kb2", "Heading"), ("kb2", "Three")}
    assert articles.listing(spark, where).count() == 5


def test_sections(spark):
    rows = spark.createDataFrame([("p", "intro\n# A\na1\na2\n## B\nb")], "path string, text string")
    assert [(r["level"], r["heading"], r["text"]) for r in articles.sections(rows).orderBy("section").collect()] == [(0, "", "intro"), (1, "A", "a1\na2"), (2, "B", "b")]


def test_session_logs(spark, tmp_path):
    use = lambda **k: {"role": "assistant", "model": k.pop("model", "m1"), "content": [], "usage": k}
    lines = [
        {"type": "user", "timestamp": "2024-01-01T10:00:00Z", "message": {"role": "user", "content": "please look at this file"}},
        {"type": "assistant", "timestamp": "2024-01-01T10:01:00Z", "message": use(input_tokens=10, output_tokens=5)},
        {"type": "assistant", "timestamp": "2024-01-01T10:02:00Z", "message": use(model="m2", cache_read_input_tokens=7)},
        {"type": "assistant", "timestamp": "2024-01-01T10:03:00Z", "message": {"role": "assistant", "content": [{"type": "text", "text": "ok"}, {"type": "tool_use", "name": "Read", "input": {"file_path": "/a"}}]}},
    ]
    (tmp_path / "s").mkdir()
    (tmp_path / "s/one.jsonl").write_text("\n".join([*map(json.dumps, lines), "not json {", ""]))
    (tmp_path / "s/subagents").mkdir()
    (tmp_path / "s/subagents/two.jsonl").write_text(json.dumps(lines[1]))
    records = logs.json_lines(spark, str(tmp_path / "s"), logs.SESSION)
    assert records.count() == 5
    got = logs.sessions(records).collect()
    assert len(got) == 1 and (got[0]["calls"], got[0]["input_tokens"], got[0]["cache_read_input_tokens"], got[0]["model"]) == (2, 10, 7, "m1")
    assert {(r["model"], r["calls"]) for r in logs.by_model(records.where(~F.col("path").contains("subagents"))).collect()} == {("m1", 1), ("m2", 1)}
    assert [(r["kind"], r["name"], r["target"]) for r in logs.blocks(records.where("message.role = 'assistant'")).orderBy("line", "pos").collect()] == [("text", None, None), ("tool", "Read", "/a")]
    assert [r["text"] for r in logs.user_messages(records).collect()] == ["please look at this file"]


def test_audit_lines(spark):
    row = spark.createDataFrame([("[2024-01-01 10:00] action=x=y model=m model=n latency=5ms [z]=1",)], "value string")
    assert logs.audit(row).first()["fields"] == {"action": "x=y", "model": "n", "latency": "5ms"}


def test_dated_entries(spark):
    text = "- **LOW** [early] before any\n## 2024-01-02 10:00\n- **HIGH** [a] one\n## 2024-01-03\ntext\n- **LOW** [b] two"
    got = logs.dated_entries(spark.createDataFrame([("p", text)], "path string, text string")).orderBy("pos").collect()
    assert [(r["ts"], r["severity"], r["kind"], r["detail"]) for r in got] == [(None, "LOW", "early", "before any"), ("2024-01-02 10:00", "HIGH", "a", "one"), ("2024-01-03", "LOW", "b", "two")]


def test_subtitles(spark):
    vtt = "WEBVTT\nKind: captions\n\n1\n00:01.000 --> 00:02.000\n<c>Hello there.</c>\nHello there.\n[Music]\n\n2\n00:03.000 --> 00:04.000\nA. B. C. D. E."
    rows = spark.createDataFrame([("p", vtt)], "path string, text string")
    assert [r["line"] for r in subtitles.spoken(rows).orderBy("pos").collect()] == ["Hello there.", "A. B. C. D. E."]
    assert subtitles.transcript(rows).first()["text"] == "Hello there. A. B. C.\n\nD. E."


def test_html():
    page = "<html><head><title>T</title><style>x</style></head><body><nav>n</nav><h1>A &amp; B</h1><p>One <a href='/x'>two</a></p><ul><li>i</li></ul><script>s</script></body></html>"
    assert html.to_markdown(page) == "T# A & B\n\nOne [two](/x)\n\n- i" or html.to_markdown(page).endswith("# A & B\n\nOne [two](/x)\n\n- i")
    assert html.embedded('self.push([1,"<p>a\\n"])x.push([1,"b</p>"])x.push([1,"\\q"])') == "<p>a\nb</p>"


def test_feed_and_sitemap(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>a</title><link>l</link><pubDate>d</pubDate></item><item><title>b</title></item></channel></rss>")
    assert sorted(r["title"] for r in html.feed(spark, str(tmp_path / "f.xml")).collect()) == ["a", "b"]
    xml = spark.createDataFrame([("<loc> http://a/x </loc><loc>http://a/m.xml</loc>",)], "x string")
    assert xml.select(html.sitemap_urls(F.col("x"))).first()[0] == ["http://a/x"]


def test_config(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"id": "a", "domains": ["all"], "connections": {"b": 1}}]))
    assert config.rules(spark, config.load(str(tmp_path / "r.json"))).first()["links"] == {"b": 1.0}


def test_sinks(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v long, at long")
    old, new = rows(("a", 1, 1), ("b", 2, 5)), rows(("a", 9, 1), ("b", 0, 4), ("c", 3, 1))
    assert sorted(map(tuple, sinks.upserted(old, new, "k", "at").collect())) == [("a", 9, 1), ("b", 2, 5), ("c", 3, 1)]
    assert sorted(r["k"] for r in sinks.buffered(old, rows(("a", 7, 9), ("d", 1, 8)), "k", "at", most=2).collect()) == ["b", "d"]
    assert [r["k"] for r in sinks.last_rows(old, F.col("at"), 1).collect()] == ["b"]
    links = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], "i int, t string")
    assert sinks.counted_links(links, "i", "t")[1].first()["n"] == 2
    a = spark.createDataFrame([("p", "x"), ("q", "y"), ("r", "z")], "path string, text string")
    b = spark.createDataFrame([("p", "x"), ("q", "other")], "path string, text string")
    assert sinks.copied_right(a, b).first()[:] == (3, 2, 1, 1)
    text = sinks.with_front_matter(spark.createDataFrame([("T", None, "b")], "title string, author string, body string"), ("title", "author")).first()["text"]
    assert text == '---\ntitle: "T"\n---\n\nb'
    sinks.write_texts(a.withColumnRenamed("path", "name"), str(tmp_path / "out"))
    sinks.write_texts(a.withColumnRenamed("path", "name"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 6


@pytest.fixture
def event_stream(spark, tmp_path):
    source = "/root/testdata/sf0.001/events.parquet"
    if not Path(source).exists():
        pytest.skip("no test tables")
    batch = spark.read.parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartitionByRange(4, "ts").write.parquet(str(tmp_path / "in"))
    return batch, streams.events(spark, str(tmp_path / "in"), batch.schema, 1)


def finished(spark, rows, mode, name):
    q = rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streams_give_the_batch_rows(spark, event_stream):
    batch, stream = event_stream
    want = {tuple(r) for r in streams.daily_counts(batch).collect()}
    assert {tuple(r) for r in finished(spark, streams.daily_counts(stream), "complete", "daily").collect()} == want
    got = {(r["user_id"], r["start"], r["n"]) for r in finished(spark, streams.sessions(stream, minutes=600, late="40 days"), "complete", "sess").collect()}
    assert got == {(r["user_id"], r["start"], r["n"]) for r in streams.sessions(batch, minutes=600).collect()}


def stream_folder(tmp_path):
    return str(tmp_path / "in")


def test_streamed_rule_state_equals_the_fold(spark, event_stream, tmp_path):
    from tallyloom.operators import rules

    batch, stream = event_stream
    shaped = lambda d: d.select(F.col("event_type").alias("rule"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), F.when(F.col("event_id") % 3 == 0, "violation").when(F.col("event_id") % 7 == 0, "sleep").otherwise("day").alias("kind"), F.lit("hook").alias("source"), F.lit(1).cast("long").alias("n"))
    # one batch, so that events arrive in order
    whole = streams.events(spark, stream_folder(tmp_path), batch.schema, 16)
    out = finished(spark, streams.rule_states(shaped(whole)), "update", "rule_states").collect()
    last = {r["rule"]: r for r in out}
    for r in rules.folded(shaped(batch)).collect():
        assert last[r["rule"]]["activations"] == r["activations"] and last[r["rule"]]["reactivations"] == r["reactivations"] and last[r["rule"]]["spike"] == pytest.approx(r["spike"])


def test_files_are_processed_once(spark, event_stream, tmp_path):
    batch, stream = event_stream
    seen = []
    for _ in range(2):
        streams.process_once(stream, lambda d, i: seen.append(d.count()), str(tmp_path / "ck")).awaitTermination(120)
    assert sum(seen) == batch.count()
