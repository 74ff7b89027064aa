"""Versions, memos, migrations, listings, appends, timers, documents without a schema, observed checks."""

import json
import os
import subprocess
import sys
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import observed as O
from tallyloom.sources import variants as A
from tallyloom.sources import versions as V
from tallyloom.streaming import streams, timers

ROOT = Path(__file__).resolve().parent.parent


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_readers_see_the_old_or_the_new_whole(spark, tmp_path):
    kept = V.Versions(spark, str(tmp_path / "t"))
    assert kept.current() is None and kept.log() == [] and kept.rollback() is None
    old = kept.publish(spark.range(5))
    new = kept.publish(old.selectExpr("id * 10 AS id"), note="ten")
    assert ids(old) == [0, 1, 2, 3, 4] and ids(new) == [0, 10, 20, 30, 40] and kept.log()[-1]["note"] == "ten"
    staged = kept.stage(spark.range(99))  # a writer that died before its commit
    assert ids(kept.current()) == [0, 10, 20, 30, 40]
    assert ids(kept.rollback()) == [0, 1, 2, 3, 4]
    assert kept.clear(1) == 2 and not (tmp_path / "t" / staged).exists() and ids(kept.current()) == [0, 1, 2, 3, 4]


def test_a_writer_that_is_killed_leaves_the_old_rows(spark, tmp_path):
    """Another process dies between staging and commit, and one inside its write."""
    path = str(tmp_path / "t")
    V.Versions(spark, path).publish(spark.range(3))
    code = """
import os, sys
from pyspark.sql import functions as F
from tallyloom.session import local
from tallyloom.sources.versions import Versions
spark = local(1, 1, "1g")
kept = Versions(spark, sys.argv[1])
if sys.argv[2] == "staged":
    kept._point = lambda entries: os._exit(9)
    kept.publish(spark.range(50))
else:
    kept.publish(spark.range(50).select(F.raise_error(F.lit("dead")).alias("id")))
"""
    for how in ("staged", "writing"):
        done = subprocess.run([sys.executable, "-c", code, path, how], cwd=ROOT, env={**os.environ, "PYTHONPATH": os.pathsep.join([str(ROOT), *sys.path])}, capture_output=True, check=False)
        assert done.returncode != 0
        assert ids(V.Versions(spark, path).current()) == [0, 1, 2] and len(os.listdir(path)) > 3


def test_memo_reads_the_source_once_for_each_version(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(10).write.parquet(source)
    kept = V.Versions(spark, str(tmp_path / "memo"))
    scans = []

    def make():
        scans.append(1)
        return spark.read.parquet(source).agg(F.count("*").alias("id"))

    ask = lambda now, seconds=30: V.memo(kept, V.version_of(spark, source), make, seconds, now)
    assert ids(ask(100)) == [10] and len(scans) == 1
    second = ask(129)
    assert ids(second) == [10] and len(scans) == 1 and not any(source in f for f in second.inputFiles())
    assert ids(ask(130)) == [10] and len(scans) == 2  # expired
    spark.range(5).write.mode("append").parquet(source)
    assert ids(ask(131)) == [15] and len(scans) == 3  # a new version of the source
    spark.range(7).write.mode("overwrite").parquet(source)
    assert ids(ask(132)) == [7] and len(scans) == 4


def test_migration_is_verified_and_undone(spark, tmp_path):
    files = spark.createDataFrame([("a", "x"), ("b", "é"), ("c", "")], "path string, text string")
    target = V.Versions(spark, str(tmp_path / "t"))
    assert V.migrate(target, files).isEmpty()
    before = sorted(map(tuple, target.current().collect()))
    more = files.unionByName(spark.createDataFrame([("d", "new")], files.schema))
    wrong = {tuple(r) for r in V.migrate(target, more, lambda rows: rows.where("path <> 'd'").withColumn("text", F.when(F.col("path") == "b", "e").otherwise(F.col("text")))).collect()}
    assert wrong == {("d", "missing"), ("b", "different")} and sorted(map(tuple, target.current().collect())) == before
    assert V.migrate(target, more).isEmpty() and target.current().count() == 4
    target.rollback()
    assert sorted(map(tuple, target.current().collect())) == before and V.verified(target).isEmpty()
    V.differing(V.manifest(files), V.manifest(more)).collect()
    broken = next((tmp_path / "t").glob(f"{target.log()[-1]['name']}/part-*.parquet"))
    spark.createDataFrame([("a", "changed on disk")], files.schema).coalesce(1).write.parquet(str(tmp_path / "other"))
    broken.write_bytes(next((tmp_path / "other").glob("part-*.parquet")).read_bytes())
    for crc in broken.parent.glob(".*.crc"):
        crc.unlink()
    assert not V.verified(target).isEmpty()


def test_only_changed_files_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "PATHS", 2)
    folder = tmp_path / "f" / "deep er"
    folder.mkdir(parents=True)
    for i in range(5):
        (folder / f"{i}.md").write_text(f"text {i}")
    (folder / "no.txt").write_text("x")
    kept = V.Versions(spark, str(tmp_path / "s"))
    read = []

    def scan():
        found = {}
        for rows in V.changed_files(kept, str(tmp_path / "f")):
            got = rows.collect()
            found |= {r["path"].rpartition("/")[2]: r["text"] for r in got}
            read.append(len(got))
        return found

    assert scan() == {f"{i}.md": f"text {i}" for i in range(5)} and len(read) == 3
    read.clear()
    assert scan() == {} and read == []
    time.sleep(1.1)
    (folder / "1.md").write_text("other")
    (folder / "2.md").write_text("text 2")  # again, with the same text: read, but not given
    (folder / "9.md").write_text("nine")
    (folder / "0.md").unlink()
    assert scan() == {"1.md": "other", "9.md": "nine"} and sum(read) == 2
    assert kept.current().count() == 5
    (folder / "7.md").write_text("seven")
    next(V.changed_files(kept, str(tmp_path / "f")))  # a caller that dies before it has taken all
    assert scan() == {"7.md": "seven"}


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    spark.range(20).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.append_once(stream(), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    read = lambda: streams.read_appended(spark, str(tmp_path / "out"), "id long")
    assert ids(read()) == list(range(20)) and read().select("batch").distinct().count() > 1
    commits = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()  # as if it had died after writing, before its commit
    (tmp_path / "ck" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    streams.append_once(stream(), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert ids(read()) == list(range(20))
    spark.range(20, 25).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    streams.append_once(stream(), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert ids(read()) == list(range(25)) and json.loads(next((tmp_path / "out").glob("batch=*/part-*.json")).read_text().splitlines()[0]).keys() == {"id"}


@pytest.fixture
def timed(spark):
    before = spark.conf.get(timers.STORE[0])
    spark.conf.set(*timers.STORE)
    yield spark
    spark.conf.set(timers.STORE[0], before)


EVENTS = [
    ("a", "2024-01-01 10:00:00", "violation", "hook"), ("a", "2024-01-03 10:00:00", "violation", "audit"), ("a", "2024-01-03 11:00:00", "sleep", ""), ("b", "2024-01-20 00:00:10", "activation", ""), ("c", "2024-01-21 00:00:10", "violation", "hook"),
    ("a", "2024-01-22 00:00:10", "violation", "hook"), ("b", "2024-04-20 00:00:10", "activation", ""), ("d", "2024-04-20 00:00:11", "violation", "x"),
]


def drained(spark, rows, schema, path, make):
    """What a stream gives whose batches are given one by one."""
    for batch in rows:
        spark.createDataFrame(batch, schema).withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(schema.replace("at string", "at timestamp")).parquet(f"{path}/in")
        streams.append_once(make(stream), f"{path}/out", f"{path}/ck", "parquet").awaitTermination()


def test_rules_change_without_events(timed, tmp_path):
    spark, schema = timed, "rule string, at string, kind string, source string"
    drained(spark, [EVENTS[:3], EVENTS[3:5], EVENTS[5:]], schema, tmp_path, timers.rule_states)
    rows = streams.read_appended(spark, f"{tmp_path}/out", f"{timers.OUTPUT}, batch long", "parquet")
    woken = rows.where("rule = 'c' AND cause = 'time'").collect()
    assert woken and woken[-1]["spike"] == 0.0 and woken[-1]["candidate"] and woken[-1]["idle_days"] == 90
    last = rows.groupBy("rule").agg(F.max_by(F.struct("*"), F.struct("batch", "day", "cause")).alias("s")).select("s.*")
    want = timers.rule_states_in_batch(spark.createDataFrame(EVENTS, schema).withColumn("at", F.to_timestamp("at")), datetime(2024, 4, 20, 0, 0, 11))  # noqa: DTZ001
    plain = lambda df: sorted((r["rule"], round(r["spike"], 9), r["dormant"], r["idle_days"], r["activations"], r["reactivations"], r["day"], r["candidate"]) for r in df.collect())
    assert plain(last) == plain(want)
    assert [r["reactivations"] for r in want.where("rule = 'a'").collect()] == [1]


def test_rules_are_forgotten(timed, tmp_path):
    spark, schema = timed, "rule string, at string, kind string, source string"
    parts = [[("a", "2024-01-01 00:00:01", "activation", "")], [("b", "2024-03-01 00:00:01", "activation", "")], [("a", "2024-03-02 00:00:01", "activation", "")]]
    drained(spark, parts, schema, tmp_path, lambda s: timers.rule_states(s, forget=30))
    rows = streams.read_appended(spark, f"{tmp_path}/out", f"{timers.OUTPUT}, batch long", "parquet").where("rule = 'a'").orderBy("batch", "day", "cause").collect()
    assert [(r["activations"], r["cause"]) for r in rows][:3] == [(1, "event"), (1, "time"), (1, "event")]  # counted from 0 again


def test_pairs_cool_down_by_timer(timed, tmp_path):
    spark, schema = timed, "pair string, at string"
    parts = [[("x|y", "2024-01-01 12:00:00"), ("u|v", "2024-01-05 12:00:00")], [("x|y", "2024-01-20 12:00:00")], [("o|p", "2024-02-10 00:00:00")], [("o|p", "2024-03-10 00:00:00")]]
    drained(spark, parts, schema, tmp_path, lambda s: timers.cooling(s, days=30))
    rows = streams.read_appended(spark, f"{tmp_path}/out", f"{timers.COOLING}, batch long", "parquet")
    free = {r["pair"]: r["batch"] for r in rows.where("free").collect()}
    assert free.keys() == {"x|y", "u|v"} and free["u|v"] < free["x|y"]  # set apart again, x|y waits for longer


def test_documents_of_many_shapes(spark):
    texts = ['{"a": {"b": 1}, "n": "7"}', '{"a": [1, 2], "n": 7}', '{"n": null}', "[]", "no json", None, '{"a": {"b": "x"}}']
    rows = A.parsed(spark.createDataFrame(list(enumerate(texts)), "id int, text string"))
    got = rows.select("id", *A.fields(F.col("state"), {"b": ("$.a.b", "int"), "n": ("$.n", "long")}, {"n": -1})).orderBy("id").collect()
    assert [(r["b"], r["n"]) for r in got] == [(1, 7), (None, 7), (None, -1), (None, -1), (None, -1), (None, -1), (None, -1)]
    assert A.shapes(rows).where("shape IS NULL").first()["n"] == 2 and A.merged_shape(rows.where("id IN (1, 2)")).startswith("OBJECT<a: ARRAY<")
    assert rows.select(A.first_of(F.col("state"), "string", "$.zz", "$.n").alias("x")).first()["x"] == "7"


def test_checks_ride_along_with_one_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    watch = O.Watch("t", spark.read.parquet(str(tmp_path / "t")), [O.Check("rows", F.count("*"), least=1), O.Check("most", F.max("id"), most=50), O.Check("mean", F.avg("id"), most=10, severe=False)])
    found = O.run([watch], lambda rows: rows.write.parquet(str(tmp_path / "copy")))
    assert found == [("rows", "t", 100.0, "ok"), ("most", "t", 99.0, "failed"), ("mean", "t", 49.5, "warning")] and spark.read.parquet(str(tmp_path / "copy")).count() == 100
    assert watch.rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    broken = O.Watch("u", spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), [O.Check("rows", F.count("x"))])
    found += O.run([broken])
    assert found[-1][3].startswith("crash") and O.summary(found) == {"ok": 1, "failed": 1, "warning": 1, "crash": 1}
    assert [r["status"].split(":")[0] for r in O.table_of(spark, found).collect()] == ["crash", "failed", "warning", "ok"]
    with pytest.raises(ValueError, match="different names"):
        O.Watch("t", spark.range(1), [O.Check("x", F.count("*"))] * 2)
