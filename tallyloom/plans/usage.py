"""Queries on the event log: usage windows, costs, energy, and what follows from them.

A type stands for a model class where one is asked for: signup large, purchase medium, click small, others none.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import patterns as P
from ..functions import scoring as S
from ..operators import usage as U
from .registry import query, table

MODELS = {"signup": "large-1", "purchase": "medium-7", "click": "small-1", "error": "nobody"}


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _model():
    out = F.lit("unlisted")
    for k, v in MODELS.items():
        out = F.when(F.col("event_type") == k, v).otherwise(out)
    return out


_MODEL = "CASE event_type WHEN 'signup' THEN 'large-1' WHEN 'purchase' THEN 'medium-7' WHEN 'click' THEN 'small-1' WHEN 'error' THEN 'nobody' ELSE 'unlisted' END"
_CLASS = "CASE event_type WHEN 'signup' THEN 'large' WHEN 'purchase' THEN 'medium' WHEN 'click' THEN 'small' ELSE 'other' END"
_WH = f"CASE {_CLASS} WHEN 'large' THEN CAST(2.0 AS DOUBLE) WHEN 'medium' THEN 0.8 WHEN 'small' THEN 0.2 ELSE 0.9 END"


@query("SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 6) AS total FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 18000 PRECEDING AND CURRENT ROW)")
def events_rolling_5h(spark, sf_dir):
    """By user, the trailing five hours of each event."""
    return U.rolling(_events(spark, sf_dir), 5 * 3600, "user_id").select("event_id", "n", F.round("total", 6).alias("total"))


@query("SELECT count(*) AS n, round(sum(value), 6) AS tokens, round(100 * sum(value) / 500000, 1) AS pct FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 5 HOURS")
def events_current_window(spark, sf_dir):
    """The five hours before the last event, against a budget."""
    e = _events(spark, sf_dir)
    last = e.agg(F.max("ts").alias("as_of"))
    rows = e.join(F.broadcast(last)).transform(lambda d: U.in_window(d, F.col("as_of"), 5))
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("tokens"), F.round(100 * F.sum("value") / 500000, 1).alias("pct"))


@query("""
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (ORDER BY ts, event_id) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (ORDER BY ts, event_id) AS sid FROM g)
SELECT min(ts) AS start, max(ts) AS "end", count(*) AS n, round(sum(value), 4) AS value FROM s GROUP BY sid
""")
def events_gap_sessions(spark, sf_dir):
    """Of the whole stream."""
    return U.stream_sessions(_events(spark, sf_dir)).withColumn("value", F.round("value", 4))


@query("""
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 4 HOURS THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g)
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS n, round(sum(value), 4) AS value FROM s GROUP BY user_id, sid
""")
def events_user_sessions(spark, sf_dir):
    return U.gap_sessions(_events(spark, sf_dir), 240, "user_id").withColumn("value", F.round("value", 4))


@query("""
WITH r AS (SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 12 HOURS),
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (ORDER BY ts, event_id) < INTERVAL 10 MINUTES THEN 0 ELSE 1 END AS new FROM r),
m AS (SELECT max(ts) AS start FROM g WHERE new = 1)
SELECT (SELECT start FROM m) AS start, count(*) AS n, round(sum(value), 4) AS value FROM r WHERE ts >= (SELECT start FROM m)
""")
def events_last_gap_window(spark, sf_dir):
    e = _events(spark, sf_dir)
    last = e.agg(F.max("ts").alias("as_of"))
    out = U.since_last_gap(e.join(F.broadcast(last)), F.col("as_of"), 10)
    return out.withColumn("value", F.round("value", 4))


@query("""
SELECT date_trunc('week', ts) AS week, count(*) FILTER (event_type = 'signup') AS large_calls, count(*) FILTER (event_type <> 'signup') AS other_calls, round(coalesce(sum(value) FILTER (event_type = 'signup'), 0), 4) AS large_tokens, round(coalesce(sum(value) FILTER (event_type <> 'signup'), 0), 4) AS other_tokens
FROM events GROUP BY 1
""")
def events_weekly_class_rollup(spark, sf_dir):
    """Two classes: the large one, and all else."""
    large = F.col("event_type") == "signup"
    part = lambda c: F.round(F.coalesce(F.sum(F.when(c, F.col("value"))), F.lit(0.0)), 4)
    return _events(spark, sf_dir).groupBy(F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week")).agg(F.count_if(large).alias("large_calls"), F.count_if(~large).alias("other_calls"), part(large).alias("large_tokens"), part(~large).alias("other_tokens"))


def _usage(spark, sf_dir):
    v = F.col("value")
    return _events(spark, sf_dir).select("event_id", "user_id", "ts", _model().alias("model"), v.alias("input"), (v / 2).alias("output"), (v / 4).alias("cache_write"), (v * 3).alias("cache_read"))


_UNIT = "(value * pi + value / 2 * po + value / 4 * pi * 1.25 + value * 3 * pi * 0.1)"
_PRICED = f"""
m AS (SELECT *, {_MODEL} AS model FROM events),
p(model, cls, pi, po) AS (VALUES ('large-1', 'large', CAST(15.0 / 1000000 AS DOUBLE), CAST(75.0 / 1000000 AS DOUBLE)), ('medium-1', 'medium', 3.0 / 1000000, 15.0 / 1000000), ('small-1', 'small', 0.8 / 1000000, 4.0 / 1000000))
"""


@query(f"""
WITH {_PRICED},
x AS (SELECT m.*, coalesce(a.pi, b.pi, 3.0 / 1000000) AS pi, coalesce(a.po, b.po, 15.0 / 1000000) AS po FROM m LEFT JOIN p a ON a.model = m.model LEFT JOIN p b ON contains(m.model, b.cls))
SELECT user_id, count(*) AS calls, round(sum({_UNIT}), 8) AS cost FROM x GROUP BY user_id
""")
def events_cost_fallback_join(spark, sf_dir):
    """By user: the model's price, else its class's, else the default."""
    return U.priced(_usage(spark, sf_dir)).groupBy("user_id").agg(F.count("*").alias("calls"), F.round(F.sum("cost"), 8).alias("cost"))


@query(f"""
WITH {_PRICED},
x AS (SELECT m.*, coalesce(a.pi, 3.0 / 1000000) AS pi, coalesce(a.po, 15.0 / 1000000) AS po FROM m LEFT JOIN p a ON a.model = m.model)
SELECT model, count(*) AS calls, round(sum(value), 4) AS input, round(sum({_UNIT}), 8) AS cost FROM x GROUP BY model
""")
def cost_by_model(spark, sf_dir):
    """The table by model falls back straight to the default price, so it need not add up to the total."""
    return U.priced(_usage(spark, sf_dir), by_class=False).groupBy("model").agg(F.count("*").alias("calls"), F.round(F.sum("input"), 4).alias("input"), F.round(F.sum("cost"), 8).alias("cost"))


@query(f"""
WITH {_PRICED},
x AS (SELECT m.*, coalesce(a.pi, b.pi, 3.0 / 1000000) AS pi, coalesce(a.po, b.po, 15.0 / 1000000) AS po FROM m LEFT JOIN p a ON a.model = m.model LEFT JOIN p b ON contains(m.model, b.cls)),
t AS (SELECT max(ts) AS as_of, min(ts) AS first FROM events)
SELECT round(sum({_UNIT}) FILTER (ts >= date_trunc('month', as_of)), 6) AS month_cost, count(DISTINCT user_id) FILTER (ts >= date_trunc('month', as_of)) AS month_sessions, round(sum({_UNIT}), 6) AS lifetime_cost,
  round(sum({_UNIT}) / (greatest(1.0, (epoch(max(as_of)) - epoch(max(first))) / 86400 / 30.44) * 200), 6) AS multiple FROM x, t
""")
def lifetime_value(spark, sf_dir):
    """Month to date, lifetime, and the multiple of a subscription's price."""
    rows = U.priced(_usage(spark, sf_dir))
    span = rows.agg(F.max("ts").alias("as_of"), F.min("ts").alias("first"))
    month = F.col("ts") >= F.date_trunc("month", F.col("as_of"))
    months = F.greatest(F.lit(1.0), (D.seconds(F.max("as_of")) - D.seconds(F.max("first"))) / 86400 / 30.44)
    return rows.join(F.broadcast(span)).agg(F.round(F.sum(F.when(month, F.col("cost"))), 6).alias("month_cost"), F.countDistinct(F.when(month, F.col("user_id"))).alias("month_sessions"), F.round(F.sum("cost"), 6).alias("lifetime_cost"), F.round(F.sum("cost") / (months * 200), 6).alias("multiple"))


@query(f"""
SELECT {_CLASS} AS class, count(*) AS calls, round(sum({_WH} * 1.135), 1) AS wh, round(sum({_WH} * 1.135 / 1000 * 379.0), 1) AS grams FROM events GROUP BY ROLLUP ({_CLASS})
""")
def events_carbon_rollup(spark, sf_dir):
    calls = _events(spark, sf_dir).groupBy(S.model_class(_model()).alias("class")).agg(F.count("*").alias("calls"))
    return U.energy(calls)


@query(f"""
WITH g AS (SELECT sum({_WH} * 1.135 / 1000 * 379.0) AS g FROM events)
SELECT k AS kind, round(g / per, 4) AS amount FROM g, (VALUES ('searches', CAST(0.2 AS DOUBLE)), ('charges', 12.4), ('miles', 393.0), ('video_hours', 36.0), ('cups', 21.0)) AS e(k, per)
""")
def equivalence_table(spark, sf_dir):
    calls = _events(spark, sf_dir).groupBy(S.model_class(_model()).alias("class")).agg(F.count("*").alias("calls"))
    g = calls.agg(F.sum(S.grams(S.watt_hours(F.col("class"), F.col("calls")))).alias("g"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("per")) for k, v in P.EQUIVALENTS.items()]))
    return g.select("g", each.alias("e")).select("e.kind", F.round(F.col("g") / F.col("e.per"), 4).alias("amount"))


_DAY_PCT = "WITH d AS (SELECT date_trunc('day', ts) AS day, sum(value) AS v FROM events GROUP BY 1), p AS (SELECT day, round(100 * v / (SELECT max(v) FROM d), 1) AS pct FROM d)"
_LEVEL = "CASE WHEN pct >= 95 THEN 'limit' WHEN pct >= 85 THEN 'critical' WHEN pct >= 70 THEN 'warning' WHEN pct >= 50 THEN 'info' ELSE 'ok' END"


def _day_pct(spark, sf_dir):
    days = _events(spark, sf_dir).groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.sum("value").alias("v"))
    return days.join(F.broadcast(days.agg(F.max("v").alias("m")))).select("day", F.round(100 * F.col("v") / F.col("m"), 1).alias("pct"))


@query(f"""
{_DAY_PCT} SELECT day, pct, {_LEVEL} AS level, CASE WHEN pct >= 95 THEN 'wind_down' WHEN pct >= 70 THEN 'medium' ELSE 'large' END AS recommended,
CASE WHEN pct >= 100 THEN 100 WHEN pct >= 95 THEN 95 WHEN pct >= 90 THEN 90 WHEN pct >= 80 THEN 80 WHEN pct >= 70 THEN 70 WHEN pct >= 60 THEN 60 WHEN pct >= 50 THEN 50 END AS alert FROM p
""")
def alert_ladder(spark, sf_dir):
    """By day, against the busiest day. The highest threshold reached is the alert."""
    pct = F.col("pct")
    return _day_pct(spark, sf_dir).select("day", "pct", S.alert_level(pct).alias("level"), S.recommendation(pct).alias("recommended"), S.highest_alert(pct).alias("alert"))


@query(f"""
{_DAY_PCT}, l AS (SELECT day, {_LEVEL} AS level FROM p), w AS (SELECT day, level, lag(level) OVER (ORDER BY day) AS before FROM l)
SELECT day, before, level, before IN ('warning', 'critical', 'limit') AND level = 'ok' AS reset FROM w WHERE before <> level
""")
def alert_transitions(spark, sf_dir):
    """Days on which the level changes; one row for each day is all that the order is taken over."""
    rows = _day_pct(spark, sf_dir).select("day", S.alert_level(F.col("pct")).alias("level"))
    rows = rows.withColumn("before", F.lag("level").over(Window.orderBy("day"))).where("before != level")
    return rows.select("day", "before", "level", (F.col("before").isin("warning", "critical", "limit") & (F.col("level") == "ok")).alias("reset"))


@query("""
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS calls, round(sum(value), 4) AS tokens, arg_min(event_type, event_id) AS first_type, CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 60) AS BIGINT) AS minutes
FROM events GROUP BY user_id ORDER BY max(ts) DESC, user_id LIMIT 20
""")
def session_history(spark, sf_dir):
    rows = _events(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("calls"), F.round(F.sum("value"), 4).alias("tokens"), F.min_by("event_type", "event_id").alias("first_type"))
    minutes = F.floor((D.seconds(F.col("end")) - D.seconds(F.col("start"))) / 60).cast("long")
    return rows.withColumn("minutes", minutes).orderBy(F.desc("end"), "user_id").limit(20)


@query("SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 60 PRECEDING AND CURRENT ROW) AS calls, 15 - count(*) OVER (PARTITION BY user_id ORDER BY s RANGE BETWEEN 60 PRECEDING AND CURRENT ROW) > 3 AS allowed FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)")
def rate_limit_window(spark, sf_dir):
    """Calls of the last minute, and whether more than the headroom is left."""
    rows = U.rolling(_events(spark, sf_dir), 60, "user_id")
    return rows.select("event_id", "user_id", F.col("n").alias("calls"), ((F.lit(15) - F.col("n")) > 3).alias("allowed"))


@query("SELECT date_trunc('day', ts) AS day, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS value FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 7")
def daily_counts_last7(spark, sf_dir):
    days = _events(spark, sf_dir).groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("value"))
    return days.orderBy(F.desc("day")).limit(7)


@query("""
WITH j AS (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type, count(*) AS n, count(k) AS with_k, CAST(sum(k) AS BIGINT) AS total, min(k) AS least, max(k) AS most FROM j GROUP BY event_type
""")
def props_json_stats(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return _events(spark, sf_dir).select("event_type", k.alias("k")).groupBy("event_type").agg(F.count("*").alias("n"), F.count("k").alias("with_k"), F.sum("k").alias("total"), F.min("k").alias("least"), F.max("k").alias("most"))


_LINE = "'[' || strftime(ts, '%Y-%m-%d') || '] action=' || event_type || ' model=' || CASE WHEN user_id % 3 = 0 THEN 'small' ELSE 'large' END || ' prefetch=' || CASE WHEN event_id % 4 = 0 THEN 'FAIL' ELSE 'OK' END || ' latency=' || CAST(event_id % 700 AS VARCHAR) || 'ms source=' || CASE WHEN event_id % 5 = 0 THEN 'skill:x' ELSE 'natural' END"


def _audit(spark, sf_dir):
    from ..sources import logs

    part = lambda name, value: [F.lit(f" {name}="), value]
    line = F.concat(
        F.lit("["), F.date_format("ts", "yyyy-MM-dd"), F.lit("]"),
        *part("action", F.col("event_type")), *part("model", F.when(F.col("user_id") % 3 == 0, "small").otherwise("large")),
        *part("prefetch", F.when(F.col("event_id") % 4 == 0, "FAIL").otherwise("OK")), *part("latency", F.concat((F.col("event_id") % 700).cast("string"), F.lit("ms"))),
        *part("source", F.when(F.col("event_id") % 5 == 0, "skill:x").otherwise("natural")),
    )
    return logs.audit(_events(spark, sf_dir).select(line.alias("line")), "line")


@query("""
SELECT event_type AS action, CASE WHEN user_id % 3 = 0 THEN 'small' ELSE 'large' END AS model, count(*) AS n, count(*) FILTER (event_id % 4 <> 0) AS prefetched, CAST(sum(event_id % 700) // greatest(count(*), 1) AS BIGINT) AS mean_latency, 100 * count(*) FILTER (event_id % 4 <> 0) // count(*) AS pct,
  count(*) FILTER (event_id % 5 = 0) AS by_skill FROM events GROUP BY ALL
""")
def audit_counters(spark, sf_dir):
    """From log lines of key=value parts."""
    kv = lambda k: F.try_element_at("fields", F.lit(k))
    rows = _audit(spark, sf_dir).select(kv("action").alias("action"), kv("model").alias("model"), (kv("prefetch") == "OK").alias("ok"), F.regexp_extract(kv("latency"), "[0-9]+", 0).cast("long").alias("ms"), kv("source").startswith("skill:").alias("skill"))
    n = F.greatest(F.count("*"), F.lit(1))
    return rows.groupBy("action", "model").agg(F.count("*").alias("n"), F.count_if("ok").alias("prefetched"), F.floor(F.sum("ms") / n).cast("long").alias("mean_latency"), F.floor(100 * F.count_if("ok") / n).cast("long").alias("pct"), F.count_if("skill").alias("by_skill"))


@query("""
SELECT category, model, count(*) AS calls, CAST(floor(100 * avg(ok)) AS BIGINT) AS success_pct, CAST(floor(avg(event_id % 700)) AS BIGINT) AS mean_ms, CAST(sum(ok) * 2850 AS BIGINT) AS saved
FROM (SELECT event_type AS category, CASE WHEN user_id % 3 = 0 THEN 'small' ELSE 'large' END AS model, event_id, CASE WHEN event_id % 4 <> 0 THEN 1 ELSE 0 END AS ok FROM events) GROUP BY ALL
""")
def eval_stats(spark, sf_dir):
    """By category and model: calls, success, time, tokens that templates saved."""
    ok = F.when(F.col("event_id") % 4 != 0, 1).otherwise(0)
    rows = _events(spark, sf_dir).select(F.col("event_type").alias("category"), F.when(F.col("user_id") % 3 == 0, "small").otherwise("large").alias("model"), "event_id", ok.alias("ok"))
    return rows.groupBy("category", "model").agg(F.count("*").alias("calls"), F.floor(100 * F.avg("ok")).cast("long").alias("success_pct"), F.floor(F.avg(F.col("event_id") % 700)).cast("long").alias("mean_ms"), (F.sum("ok") * 2850).alias("saved"))


@query("""
WITH d AS (SELECT date_trunc('day', ts) AS day, coalesce(sum(value) FILTER (event_type = 'click'), 0) AS saved, coalesce(sum(value) FILTER (event_type <> 'click'), 0) AS used FROM events GROUP BY 1)
SELECT day, round_even(coalesce(CASE WHEN saved + used = 0 THEN 0 ELSE saved / (saved + used) * 100 END, 0), 2) AS efficiency FROM d
""")
def efficiency_by_day(spark, sf_dir):
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("value"))), F.lit(0.0))
    click = F.col("event_type") == "click"
    days = _events(spark, sf_dir).groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(part(click).alias("saved"), part(~click).alias("used"))
    return days.select("day", F.bround(F.coalesce(F.try_divide("saved", F.col("saved") + F.col("used")) * 100, F.lit(0.0)), 2).alias("efficiency"))
