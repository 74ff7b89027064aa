"""Queries on stored state: versions and memos, migrations, listings, appended streams, timers, documents without a schema, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import observed as O
from ..sources import shared
from ..sources import variants as A
from ..sources import versions as V
from ..streaming import streams, timers
from .registry import query, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("SELECT user_id, count(*) AS n, round(sum(value), 2) AS total, 2 AS versions FROM events GROUP BY user_id")
def atomic_state(spark, sf_dir):
    """A state table that is replaced while its old version is being read: users up to the middle, then all."""
    kept = V.Versions(spark, shared.new_path(spark))
    per_user = lambda rows: rows.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    half = F.col("event_id") % 2 == 0
    old = kept.publish(per_user(_events(spark, sf_dir).where(half)))
    rest = per_user(_events(spark, sf_dir).where(~half))
    kept.publish(old.unionByName(rest).groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    return kept.current().select("user_id", "n", F.round("total", 2).alias("total"), F.lit(len(kept.log())).alias("versions"))


@query("SELECT event_type, count(*) AS n, 1 AS made FROM events GROUP BY event_type")
def memoised_counts(spark, sf_dir):
    """Asked for twice, made once: the source hasn't changed in between."""
    kept, made = V.Versions(spark, shared.new_path(spark)), []

    def make():
        made.append(1)
        return _events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"))

    version = V.version_of(spark, f"{sf_dir}/events.parquet")
    V.memo(kept, version, make, seconds=60, now=0)
    out = V.memo(kept, version, make, seconds=60, now=59)
    return out.withColumn("made", F.lit(len(made)))


@query("SELECT doc_id AS path, octet_length(encode(text))::BIGINT AS bytes, sha256(text) AS checksum FROM documents WHERE text IS NOT NULL AND doc_id % 2 = 0")
def migrated_and_rolled_back(spark, sf_dir):
    """A migration, another one after it, one that loses files and isn't committed, and the second undone."""
    files = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("path"), "text")
    target = V.Versions(spark, shared.new_path(spark))
    V.migrate(target, files.where("path % 2 = 0"))
    V.migrate(target, files)
    lost = V.migrate(target, files, lambda rows: rows.where("path % 10 <> 3"))
    if lost.isEmpty() or len(target.log()) != 2:
        raise RuntimeError("a migration that loses files was committed")
    target.rollback()
    if not V.verified(target).isEmpty():
        raise RuntimeError("what was rolled back differs from its manifest")
    return V.manifest(target.current())


@query("""
WITH a AS (SELECT doc_id AS path, length(text) AS bytes, md5(text) AS changed FROM documents WHERE doc_id % 7 <> 1), b AS (SELECT doc_id AS path, length(text) AS bytes, CASE WHEN doc_id % 5 = 2 THEN 'x' ELSE md5(text) END AS changed FROM documents WHERE doc_id % 11 <> 3)
SELECT path, CASE WHEN a.path IS NULL THEN 'added' WHEN b.path IS NULL THEN 'removed' ELSE 'changed' END AS state FROM (SELECT path, row(bytes, changed) AS m FROM a) a FULL JOIN (SELECT path, row(bytes, changed) AS m FROM b) b USING (path) WHERE a.m IS DISTINCT FROM b.m
""")
def listing_difference(spark, sf_dir):
    """What was added, removed and changed from one listing to the next."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.length("text").alias("bytes"), F.md5("text").alias("changed"))
    new = docs.where("path % 11 <> 3").withColumn("changed", F.when(F.col("path") % 5 == 2, "x").otherwise(F.col("changed")))
    return V.difference(docs.where("path % 7 <> 1"), new)


def _stream(spark, sf_dir):
    """The events as a stream, in one batch; their table is a folder of files or a file."""
    rows = _events(spark, sf_dir)
    reader = spark.readStream.schema(rows.schema)
    if rows.inputFiles()[0].endswith("/events.parquet"):
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/events.parquet")


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def appended_once(spark, sf_dir):
    """Events that a stream appends as JSON lines; its batch is tried twice, as after a crash, and adds nothing the second time."""
    path = shared.new_path(spark)
    for attempt in range(2):  # a new checkpoint has forgotten that the batch was written
        streams.append_once(_stream(spark, sf_dir).select("event_id", "event_type", "value"), f"{path}/rows", f"{path}/checkpoint{attempt}").awaitTermination()
    rows = streams.read_appended(spark, f"{path}/rows", "event_id long, event_type string, value double")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


_KIND = "CASE event_type WHEN 'purchase' THEN 'violation' WHEN 'view' THEN 'activation' WHEN 'error' THEN 'sleep' END"


@query(f"""
WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS rule, {_KIND} AS kind, epoch_ms(ts) // 86400000 AS day, CASE WHEN event_id % 2 = 0 THEN 0.15 ELSE 0.06 END::DOUBLE AS gain, ts, CASE WHEN event_id % 2 = 0 THEN 'hook' ELSE 'audit' END AS source FROM events WHERE event_type IN ('purchase', 'view', 'error')),
o AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY ts, kind, source) AS i, day - lag(day, 1, day) OVER (PARTITION BY rule ORDER BY ts, kind, source) AS gap FROM e UNION ALL SELECT rule, 'end', 0, 0, NULL, NULL, count(*) + 1, (SELECT max(day) FROM e) - max(day) FROM e GROUP BY rule),
r(rule, i, spike, dormant, idle_days, activations, reactivations) AS (
  SELECT DISTINCT rule, 0::BIGINT, 0::DOUBLE, FALSE, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM e
  UNION ALL SELECT rule, i, CASE WHEN kind = 'violation' THEN CASE WHEN dormant THEN 0.2::DOUBLE ELSE least(spike + gain, 0.15::DOUBLE) END ELSE spike END, CASE kind WHEN 'violation' THEN FALSE WHEN 'sleep' THEN TRUE ELSE dormant END,
    CASE kind WHEN 'activation' THEN 0 ELSE idle_days END, activations + (kind = 'activation')::BIGINT, reactivations + (kind = 'violation' AND dormant)::BIGINT
  FROM (SELECT r.rule, o.i, o.kind, o.gain, CASE WHEN gap = 0 THEN spike WHEN spike - gap * 0.01::DOUBLE <= 0.001 THEN 0 ELSE spike - gap * 0.01::DOUBLE END AS spike, dormant, idle_days + gap AS idle_days, activations, reactivations FROM r JOIN o ON o.rule = r.rule AND o.i = r.i + 1)),
s AS (SELECT * FROM r QUALIFY i = max(i) OVER (PARTITION BY rule))
SELECT rule, round(spike, 6) AS spike, dormant, idle_days, activations, reactivations, NOT dormant AND idle_days >= 60 AS candidate FROM s
""")
def rule_states_timed(spark, sf_dir):
    """The state of each user as a rule, from a stream with timers: days that pass change it, with or without events. Purchases are violations, views activations, errors put to sleep."""
    before = spark.conf.get(timers.STORE[0])
    spark.conf.set(*timers.STORE)
    try:
        source = F.when(F.col("event_id") % 2 == 0, "hook").otherwise("audit")
        rows = _stream(spark, sf_dir).where("event_type IN ('purchase', 'view', 'error')")
        events = rows.select(F.col("user_id").cast("string").alias("rule"), F.col("ts").cast("timestamp").alias("at"), F.expr(_KIND).alias("kind"), source.alias("source"))
        path = shared.new_path(spark)
        states = timers.rule_states(events, forget=1 << 30)
        streams.append_once(states, f"{path}/rows", f"{path}/checkpoint", "parquet").awaitTermination()
        rows = streams.read_appended(spark, f"{path}/rows", f"{timers.OUTPUT}, batch long", "parquet")
        last = rows.groupBy("rule").agg(F.max_by(F.struct("spike", "dormant", "idle_days", "activations", "reactivations", "candidate"), F.struct("batch", "day", "cause")).alias("s"))
        return last.select("rule", "s.*").withColumn("spike", F.round("spike", 6))
    finally:
        spark.conf.set(timers.STORE[0], before)


@query("""
SELECT event_type, count(*) AS n, count(*) FILTER (event_id % 4 = 3) AS broken, round(sum(CASE WHEN event_id % 4 <> 3 THEN value END), 2) AS total, sum(CASE WHEN event_id % 4 = 2 THEN 3 WHEN event_id % 4 = 3 THEN NULL ELSE 1 END)::BIGINT AS parts FROM events GROUP BY event_type
""")
def state_documents(spark, sf_dir):
    """Documents of three shapes, and some that are no JSON: the same fields under other names, at other depths and of other types."""
    value = F.format_string("%.2f", F.col("value"))
    text = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"value": '), value, F.lit(', "kind": "a"}')))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"usage": {"value": "'), value, F.lit('", "at": [1]}}')))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"total": '), value, F.lit(', "parts": [1, {"x": null}, "y"]}')))
        .otherwise("{broken")
    )
    rows = A.parsed(_events(spark, sf_dir).select("event_type", text.alias("text")))
    state = F.col("state")
    found = rows.select("event_type", state.isNull().alias("broken"), A.first_of(state, "double", "$.value", "$.usage.value", "$.total").alias("value"), F.size(A.first_of(state, "array<variant>", "$.parts", "$.usage.at")).alias("size"))
    parts = F.when(~F.col("broken"), F.when(F.col("size") > 0, F.col("size")).otherwise(1)).cast("long")
    return found.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("broken").alias("broken"), F.round(F.sum("value"), 2).alias("total"), F.sum(parts).alias("parts"))


def _check(source: str, name: str, value: str, least=None, most=None, severe=True) -> tuple:
    return source, name, value, least, most, severe


#: Thirteen checks of four tables: aggregates that Spark and SQL read alike, and their bounds.
CHECKS = (
    _check("documents", "rows", "count(*)", 1), _check("documents", "null texts", "sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END)", None, 0), _check("documents", "null languages", "sum(CASE WHEN lang IS NULL THEN 1 ELSE 0 END)", None, 0, False), _check("documents", "longest text", "max(n_chars)", None, 30000, False),
    _check("events", "rows", "count(*)", 1), _check("events", "share of errors", "avg(CASE WHEN event_type = 'error' THEN 1e0 ELSE 0e0 END)", None, 0.1), _check("events", "least value", "min(value)", 0), _check("events", "null users", "sum(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END)", None, 0),
    _check("pages", "rows", "count(*)", 1), _check("pages", "urls without a host", "sum(CASE WHEN url LIKE '%://%' THEN 0 ELSE 1 END)", None, 0), _check("pages", "empty pages", "sum(CASE WHEN html IS NULL OR html = '' THEN 1 ELSE 0 END)", None, 0),
    _check("labels", "share of good", "avg(CASE WHEN quality = 1 THEN 1e0 ELSE 0e0 END)", 0.5), _check("labels", "share of toxic", "avg(CASE WHEN toxic = 1 THEN 1e0 ELSE 0e0 END)", None, 0.05, False),
)


def _check_sql(source, name, value, least, most, severe) -> str:
    beyond = " OR ".join(([f"v < {least}"] if least is not None else []) + ([f"v > {most}"] if most is not None else []))
    return f"SELECT '{name}' AS name, '{source}' AS source, v AS value, CASE WHEN {beyond} THEN '{'failed' if severe else 'warning'}' ELSE 'ok' END AS status FROM (SELECT ({value})::DOUBLE AS v FROM {source})"


@query(" UNION ALL ".join(_check_sql(*c) for c in CHECKS))
def fan_out_checks(spark, sf_dir):
    """Thirteen checks of four tables, each table scanned once."""
    by_source: dict[str, list[O.Check]] = {}
    for source, name, value, least, most, severe in CHECKS:
        by_source.setdefault(source, []).append(O.Check(name, F.expr(value), least, most, severe))
    return O.table_of(spark, O.run([O.Watch(s, table(spark, sf_dir, s), checks) for s, checks in by_source.items()]))
