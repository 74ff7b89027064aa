"""Queries on dates: schedules, freshness, ages; over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from .registry import query, table

TODAY = "1998-08-03"
_FREQ = "CASE o_orderkey % 6 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly_monday' WHEN 2 THEN 'weekly_friday' WHEN 3 THEN 'monthly' WHEN 4 THEN 'quarterly' ELSE 'on_demand' END"
_RUNS = f"r AS (SELECT o_orderkey, {_FREQ} AS frequency, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS last, DATE '{TODAY}' AS today FROM orders)"
_LABEL = "year({0}) || '-Q' || quarter({0})"
_DUE = f"""CASE WHEN last IS NULL THEN frequency <> 'on_demand' WHEN frequency = 'daily' THEN today - last >= 1 WHEN frequency = 'weekly_monday' THEN isodow(today) = 1 AND today - last >= 1 WHEN frequency = 'weekly_friday' THEN isodow(today) = 5 AND today - last >= 1
  WHEN frequency = 'monthly' THEN today - last >= 28 WHEN frequency = 'quarterly' THEN {_LABEL.format("last")} <> {_LABEL.format("today")} ELSE false END"""
_OVERDUE = "coalesce(today - last > CASE WHEN frequency = 'daily' THEN 2 WHEN starts_with(frequency, 'weekly') THEN 8 WHEN frequency = 'monthly' THEN 35 WHEN frequency = 'quarterly' THEN 100 END, false)"
_NEXT = """CASE WHEN frequency = 'on_demand' THEN NULL WHEN last IS NULL THEN today WHEN frequency = 'daily' THEN last + 1 WHEN frequency = 'weekly_monday' THEN last + CAST(7 - (isodow(last) - 1) % 7 AS INT)
  WHEN frequency = 'weekly_friday' THEN last + CAST(CASE WHEN isodow(last) < 5 THEN 5 - isodow(last) ELSE 12 - isodow(last) END AS INT) WHEN frequency = 'monthly' THEN last + 28 WHEN frequency = 'quarterly' THEN CAST(date_trunc('quarter', last) + INTERVAL 3 MONTHS AS DATE) END"""


def _runs(spark, sf_dir):
    kinds = ("daily", "weekly_monday", "weekly_friday", "monthly", "quarterly", "on_demand")
    frequency = F.array(*[F.lit(k) for k in kinds])[(F.col("o_orderkey") % 6).cast("int")]
    last = F.when(F.col("o_orderkey") % 50 == 0, None).otherwise(F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", frequency.alias("frequency"), last.alias("last"), F.to_date(F.lit(TODAY)).alias("today"))


@query(f"WITH {_RUNS} SELECT o_orderkey, frequency, {_DUE} AS due, {_OVERDUE} AS overdue, strftime({_NEXT}, '%Y-%m-%d') AS next_due FROM r")
def schedule_due(spark, sf_dir):
    f, last, today = F.col("frequency"), F.col("last"), F.col("today")
    return _runs(spark, sf_dir).select("o_orderkey", "frequency", D.is_due(f, last, today).alias("due"), D.is_overdue(f, last, today).alias("overdue"), F.date_format(D.next_due(f, last, today), "yyyy-MM-dd").alias("next_due"))


_WEIGHT = "CASE o_orderkey % 4 WHEN 0 THEN 'light' WHEN 1 THEN 'medium' WHEN 2 THEN 'heavy' ELSE 'extreme' END"


@query(f"WITH {_RUNS}, w AS (SELECT *, {_WEIGHT} AS weight FROM r WHERE {_DUE} OR {_OVERDUE}) SELECT pct, frequency, weight, count(*) AS n FROM w, (SELECT unnest([30, 60, 80]) AS pct) WHERE pct <= 50 OR (pct > 70 AND weight = 'light') OR (pct > 50 AND pct <= 70 AND weight NOT IN ('heavy', 'extreme')) GROUP BY ALL")
def due_within_budget(spark, sf_dir):
    """What is due, without what the budget used so far forbids; for three budgets."""
    f, last, today = F.col("frequency"), F.col("last"), F.col("today")
    weight = F.array(*[F.lit(k) for k in ("light", "medium", "heavy", "extreme")])[(F.col("o_orderkey") % 4).cast("int")]
    rows = _runs(spark, sf_dir).where(D.is_due(f, last, today) | D.is_overdue(f, last, today)).select("frequency", weight.alias("weight"), F.explode(F.array(F.lit(30), F.lit(60), F.lit(80))).alias("pct"))
    allowed = (F.col("pct") <= 50) | ((F.col("pct") > 70) & (F.col("weight") == "light")) | (F.col("pct").between(51, 70) & ~F.col("weight").isin("heavy", "extreme"))
    return rows.where(allowed).groupBy("pct", "frequency", "weight").agg(F.count("*").alias("n"))


@query(f"WITH {_RUNS} SELECT CASE WHEN frequency = 'on_demand' THEN 'on demand' WHEN {_OVERDUE} THEN 'overdue' WHEN {_DUE} THEN 'due' ELSE 'upcoming' END AS part, count(*) AS n, round(100.0 * max(today - CAST(date_trunc('quarter', today) AS DATE)) / max(CAST(date_trunc('quarter', today) + INTERVAL 3 MONTHS AS DATE) - CAST(date_trunc('quarter', today) AS DATE)), 4) AS quarter_pct FROM r GROUP BY 1")
def schedule_overview(spark, sf_dir):
    f, last, today = F.col("frequency"), F.col("last"), F.col("today")
    part = F.when(f == "on_demand", "on demand").when(D.is_overdue(f, last, today), "overdue").when(D.is_due(f, last, today), "due").otherwise("upcoming")
    start = D.quarter_start(today)
    done = 100.0 * F.datediff(today, start) / F.datediff(F.add_months(start, 3), start)
    return _runs(spark, sf_dir).groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.round(F.max(done), 4).alias("quarter_pct"))


@query(f"SELECT {_LABEL.format('o_orderdate')} AS label, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def quarter_labels(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(D.quarter_label(F.col("o_orderdate")).alias("label")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""
WITH l AS (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey), t AS (SELECT max(o_orderdate) AS as_of FROM orders)
SELECT c_custkey, CASE WHEN last IS NULL THEN 'UNREAD' WHEN CAST(as_of AS DATE) - CAST(last AS DATE) > 60 THEN 'HIGH' WHEN CAST(as_of AS DATE) - CAST(last AS DATE) > 30 THEN 'MEDIUM' ELSE 'OK' END AS staleness FROM customer LEFT JOIN l ON o_custkey = c_custkey, t
""")
def freshness_buckets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    rows = table(spark, sf_dir, "customer").select("c_custkey").join(last, F.col("c_custkey") == F.col("o_custkey"), "left").join(F.broadcast(orders.agg(F.max("o_orderdate").alias("as_of"))))
    days = F.datediff("as_of", "last")
    return rows.select("c_custkey", F.when(F.col("last").isNull(), "UNREAD").otherwise(D.freshness(days)).alias("staleness"))


@query("""
WITH t AS (SELECT max(ts) AS as_of FROM events), a AS (SELECT event_id, epoch(as_of) - epoch(ts) AS s FROM events, t)
SELECT event_id, CASE WHEN s < 60 THEN CAST(floor(s) AS BIGINT) || 's' WHEN s < 3600 THEN CAST(floor(s / 60) AS BIGINT) || 'm' WHEN s < 86400 THEN CAST(floor(s / 3600) AS BIGINT) || 'h' ELSE CAST(floor(s / 86400) AS BIGINT) || 'd' END AS age FROM a
""")
def age_labels(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    rows = e.join(F.broadcast(e.agg(F.max("ts").alias("as_of"))))
    return rows.select("event_id", D.age_label(D.seconds(F.col("as_of")) - D.seconds(F.col("ts"))).alias("age"))


@query("""
WITH s AS (SELECT doc_id, md5(text) AS hash, doc_id * 10 AS changed FROM documents), k AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN md5('other') ELSE md5(text) END AS seen, doc_id * 10 + CASE WHEN doc_id % 2 = 0 THEN -1 ELSE 1 END AS read_at FROM documents WHERE doc_id % 3 <> 0)
SELECT doc_id, CASE WHEN seen IS NULL THEN 'UNREAD' WHEN changed <= read_at THEN 'FRESH' WHEN hash = seen THEN 'FRESH' ELSE 'STALE' END AS state FROM s LEFT JOIN k USING (doc_id)
""")
def reread_state(spark, sf_dir):
    """Unknown, then the time of the change, then the content's hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash"))
    known = docs.where("doc_id % 3 != 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.md5(F.lit("other"))).otherwise(F.col("hash")).alias("seen"), (F.col("doc_id") * 10 + F.when(F.col("doc_id") % 2 == 0, -1).otherwise(1)).alias("read_at"))
    rows = docs.withColumn("changed", F.col("doc_id") * 10).join(known, "doc_id", "left")
    return rows.select("doc_id", F.when(F.col("seen").isNull(), "UNREAD").when((F.col("changed") <= F.col("read_at")) | (F.col("hash") == F.col("seen")), "FRESH").otherwise("STALE").alias("state"))
