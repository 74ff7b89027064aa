"""Queries on keyed state: upserts, rotation, open sessions, folds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators import usage as U
from ..sources import sinks
from .registry import query, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("SELECT user_id, arg_max(event_type, struct_pack(t := ts, i := event_id)) AS event_type, arg_max(value, struct_pack(t := ts, i := event_id)) AS value, arg_max(event_id, struct_pack(t := ts, i := event_id)) AS event_id FROM events GROUP BY user_id")
def upsert_latest(spark, sf_dir):
    """The last version of each key."""
    return U.latest(_events(spark, sf_dir), "user_id", ["ts", "event_id"], ["event_type", "value", "event_id"])


@query("""
WITH o AS (SELECT user_id, max(value) AS value, 1 AS version FROM events WHERE event_id % 2 = 0 GROUP BY user_id), n AS (SELECT user_id, max(value) AS value, 1 AS version FROM events WHERE user_id % 3 = 0 GROUP BY user_id)
SELECT coalesce(n.user_id, o.user_id) AS user_id, CAST(coalesce(n.version, o.version) AS BIGINT) AS version, CASE WHEN n.user_id IS NULL THEN o.value ELSE n.value END AS value FROM o FULL JOIN n USING (user_id)
""")
def upsert_merge(spark, sf_dir):
    """An old table and new rows: the new one of equal versions stays."""
    part = lambda where: _events(spark, sf_dir).where(where).groupBy("user_id").agg(F.max("value").alias("value")).withColumn("version", F.lit(1).cast("long"))
    return sinks.upserted(part("event_id % 2 = 0"), part("user_id % 3 = 0"), "user_id", "version")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND length(trim(text)) >= 50")
def append_unseen(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return sinks.unseen(table(spark, sf_dir, "labels").select("doc_id"), docs.select("doc_id", "source", "text"), "doc_id").select("doc_id", "source")


@query("SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 100")
def keep_last_n(spark, sf_dir):
    return sinks.last_rows(_events(spark, sf_dir).select("event_id", "event_type"), F.col("event_id"), 100)


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL ORDER BY min(event_id) DESC LIMIT 100")
def capped_buffer(spark, sf_dir):
    """Distinct entries, the first of equal ones, the newest hundred."""
    rows = _events(spark, sf_dir).select("event_id", F.struct("user_id", "event_type").alias("entry"))
    none = rows.limit(0)
    return sinks.buffered(none, rows, "entry", "event_id").select("entry.user_id", "entry.event_type", "event_id")


@query("""
WITH s AS (SELECT user_id, event_type, ts, event_id FROM events WHERE event_type IN ('signup', 'purchase'))
SELECT user_id, event_id, ts FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type = 'signup'
""")
def latest_open_session(spark, sf_dir):
    """A signup opens, a purchase closes: users whose last one is open."""
    rows = _events(spark, sf_dir).where("event_type IN ('signup', 'purchase')")
    return U.latest(rows, "user_id", ["ts", "event_id"], ["event_id", "ts", "event_type"]).where("event_type = 'signup'").select("user_id", "event_id", "ts")


@query("SELECT user_id, event_id, p AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p % 50 = 0")
def every_fiftieth(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return _events(spark, sf_dir).withColumn("n", place.cast("long")).where("n % 50 = 0").select("user_id", "event_id", "n")


@query("SELECT user_id, event_id FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR epoch(ts) - epoch(before) >= 86400")
def debounced_events(spark, sf_dir):
    """Events without an equal one in the day before."""
    before = F.lag("ts").over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id"))
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp"))
    return _events(spark, sf_dir).withColumn("before", before).where(F.col("before").isNull() | (gap >= 86400 * 1_000_000)).select("user_id", "event_id")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) <= 3")
def top_tools(spark, sf_dir):
    rows = _events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return rows.withColumn("p", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type"))).where("p <= 3").drop("p")


@query("SELECT CAST(floor(value) AS BIGINT) AS item, count(DISTINCT user_id) AS users, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1 HAVING count(DISTINCT user_id) > 1")
def shared_entities(spark, sf_dir):
    """What several users touched."""
    rows = _events(spark, sf_dir).where("event_type = 'view'").groupBy(F.floor("value").cast("long").alias("item"), "user_id").agg(F.count("*").alias("n"))
    return rows.groupBy("item").agg(F.count("*").alias("users"), F.sum("n").alias("n")).where("users > 1")


@query("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)")
def unevaluated_sessions(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select("user_id").distinct().join(e.where("event_type = 'error' AND value > 100").select("user_id").distinct(), "user_id", "left_anti")


@query("SELECT count(*) AS n, CAST(coalesce(sum(CASE WHEN event_type = 'click' THEN event_id END), 0) AS BIGINT) AS clicks, count(*) FILTER (value > 100) AS large, count(DISTINCT user_id) AS users FROM events")
def store_statistics(spark, sf_dir):
    return _events(spark, sf_dir).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col("event_type") == "click", F.col("event_id"))), F.lit(0)).alias("clicks"), F.count_if(F.col("value") > 100).alias("large"), F.countDistinct("user_id").alias("users"))


def _rule_events(spark, sf_dir):
    """Users as rules: purchases are violations, views activations, errors put to sleep, others let days pass."""
    kind = F.when(F.col("event_type") == "purchase", "violation").when(F.col("event_type") == "view", "activation").when((F.col("event_type") == "error") & (F.col("value") > 150), "sleep").otherwise("day")
    source = F.when(F.col("event_id") % 2 == 0, "hook").otherwise("audit")
    at = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    return _events(spark, sf_dir).select(F.col("user_id").cast("string").alias("rule"), at.alias("at"), kind.alias("kind"), source.alias("source"), F.lit(1).cast("long").alias("n"))


_STATES = """
WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS rule, CASE WHEN event_type = 'purchase' THEN 'violation' WHEN event_type = 'view' THEN 'activation' WHEN event_type = 'error' AND value > 150 THEN 'sleep' ELSE 'day' END AS kind,
  CAST(CASE WHEN event_id % 2 = 0 THEN 0.15 ELSE 0.06 END AS DOUBLE) AS gain, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r(rule, i, spike, dormant, idle_days, activations, reactivations) AS (
  SELECT DISTINCT rule, CAST(0 AS BIGINT), CAST(0 AS DOUBLE), FALSE, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM e
  UNION ALL SELECT r.rule, e.i,
    CASE WHEN kind = 'violation' AND dormant THEN CAST(0.2 AS DOUBLE) WHEN kind = 'violation' THEN least(spike + gain, CAST(0.15 AS DOUBLE)) WHEN kind = 'day' THEN CASE WHEN spike - CAST(0.01 AS DOUBLE) <= CAST(0.001 AS DOUBLE) THEN CAST(0 AS DOUBLE) ELSE spike - CAST(0.01 AS DOUBLE) END ELSE spike END,
    CASE WHEN kind = 'violation' THEN FALSE WHEN kind = 'sleep' THEN TRUE ELSE dormant END,
    CASE kind WHEN 'activation' THEN 0 WHEN 'day' THEN idle_days + 1 ELSE idle_days END, activations + CASE WHEN kind = 'activation' THEN 1 ELSE 0 END, reactivations + CASE WHEN kind = 'violation' AND dormant THEN 1 ELSE 0 END
  FROM r JOIN e ON e.rule = r.rule AND e.i = r.i + 1),
s AS (SELECT rule, spike, dormant, idle_days, activations, reactivations FROM r QUALIFY i = max(i) OVER (PARTITION BY rule))
"""


@query(_STATES + "SELECT * FROM s")
def rule_state_fold(spark, sf_dir):
    """State after all events: each event's effect depends on the state before it."""
    return R.folded(_rule_events(spark, sf_dir))


@query(_STATES + "SELECT count(*) AS total, count(*) FILTER (NOT dormant) AS active, count(*) FILTER (dormant) AS dormant, count(*) FILTER (NOT dormant AND spike > 0) AS spiked, count(*) FILTER (NOT dormant AND idle_days >= 60) AS inactive FROM s")
def rule_lifecycle(spark, sf_dir):
    return R.lifecycle(R.folded(_rule_events(spark, sf_dir)))


@query("""
WITH d AS (SELECT CAST(user_id AS VARCHAR) AS rule, max(CAST(ts AS DATE)) FILTER (event_type = 'view') AS last, max(max(CAST(ts AS DATE))) OVER () AS today FROM events GROUP BY user_id)
SELECT rule, CAST(coalesce(today - last, 999) AS BIGINT) AS idle_days, round(greatest(0.0, CAST(0.15 AS DOUBLE) - CAST(0.01 AS DOUBLE) * least(coalesce(today - last, 999), 365)), 6) AS spike FROM d
""")
def decayed_spikes(spark, sf_dir):
    """The closed form of the decay: no fold is needed without events between."""
    from ..functions import scoring as S

    e = _events(spark, sf_dir)
    last = e.groupBy(F.col("user_id").cast("string").alias("rule")).agg(F.max(F.when(F.col("event_type") == "view", F.col("ts").cast("date"))).alias("last"))
    rows = last.join(F.broadcast(e.agg(F.max(F.col("ts").cast("date")).alias("today"))))
    idle = F.coalesce(F.datediff("today", "last"), F.lit(999)).cast("long")
    return rows.select("rule", idle.alias("idle_days"), F.round(S.decayed(F.lit(0.15), idle), 6).alias("spike"))
