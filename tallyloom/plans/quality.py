"""Queries on gates, trends, tests and experiments, over the event log."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..operators import usage as U
from .registry import query, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query("""
WITH r AS (SELECT event_type, event_id, CASE WHEN event_id % 3 <> 0 THEN 1 ELSE 0 END AS ok FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 20),
g AS (SELECT event_type, count(*) AS calls, CAST(sum(ok) AS BIGINT) AS good FROM r GROUP BY 1)
SELECT event_type, calls, good, round(good / calls, 6) AS rate, CASE WHEN calls < 5 THEN 'insufficient' WHEN good / calls < 0.5 THEN 'disabled' WHEN good / calls < 0.7 THEN 'warn' ELSE 'ok' END AS verdict FROM g
""")
def last_n_success_rate(spark, sf_dir):
    """Of the last twenty calls of each type."""
    return U.last_n_rate(_events(spark, sf_dir), "event_type", "event_id", F.col("event_id") % 3 != 0)


@query("""
WITH t AS (SELECT max(ts) AS as_of, min(ts) AS first FROM events),
r AS (SELECT event_type, count(*) FILTER (ts > as_of - INTERVAL 7 DAYS AND value > 150) / 7.0 AS recent, count(*) FILTER (ts <= as_of - INTERVAL 7 DAYS AND value > 150) / greatest(CAST(date_diff('day', date_trunc('day', max(first)), date_trunc('day', max(as_of))) - 7 AS DOUBLE), 1.0) AS older FROM events, t GROUP BY event_type)
SELECT event_type, round(recent, 6) AS recent, round(older, 6) AS older, CASE WHEN older = 0 THEN CASE WHEN recent = 0 THEN 'stable' ELSE 'worsening' END WHEN recent < older * CAST(0.7 AS DOUBLE) THEN 'improving' WHEN recent > older * CAST(1.3 AS DOUBLE) THEN 'worsening' ELSE 'stable' END AS trend FROM r
""")
def recent_vs_older_trend(spark, sf_dir):
    """Daily rate of large values in the last seven days against the time before."""
    e = _events(spark, sf_dir)
    span = e.agg(F.max("ts").alias("as_of"), F.min("ts").alias("first"))
    rows = e.where("value > 150").join(F.broadcast(span))
    recent = F.col("ts") > F.col("as_of") - F.expr("INTERVAL 7 DAYS")
    days = F.greatest((F.datediff("as_of", "first") - 7).cast("double"), F.lit(1.0))
    all_types = e.select("event_type").distinct()
    r = rows.groupBy("event_type").agg((F.count_if(recent) / 7.0).alias("recent"), (F.count_if(~recent) / F.max(days)).alias("older"))
    r = all_types.join(r, "event_type", "left").select("event_type", F.coalesce("recent", F.lit(0.0)).alias("recent"), F.coalesce("older", F.lit(0.0)).alias("older"))
    return r.select("event_type", F.round("recent", 6).alias("recent"), F.round("older", 6).alias("older"), S.trend(F.col("recent"), F.col("older")).alias("trend"))


_DAILY = "WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY ALL)"


def _daily(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"))


@query(f"""
{_DAILY}, l AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS before FROM d)
SELECT event_type, day, n, coalesce(before, 0) AS before, CASE WHEN before IS NULL OR before = 0 THEN 'new' WHEN (n - before) / before > 0.05 THEN 'up' WHEN (n - before) / before < -0.05 THEN 'down' ELSE 'flat' END AS trend FROM l
""")
def snapshot_trend(spark, sf_dir):
    """Each day's count against the day before."""
    before = F.lag("n").over(Window.partitionBy("event_type").orderBy("day"))
    return _daily(spark, sf_dir).withColumn("before", F.coalesce(before, F.lit(0))).withColumn("trend", S.snapshot_trend(F.col("n"), F.col("before")))


@query(f"""
{_DAILY}, l AS (SELECT *, lag(n, 2) OVER (PARTITION BY event_type ORDER BY day) AS before FROM d)
SELECT event_type, day, CASE WHEN before IS NULL THEN '-' WHEN n > before THEN 'up' WHEN n < before THEN 'down' ELSE 'flat' END AS arrow FROM l QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY day DESC) = 1
""")
def trend_arrow(spark, sf_dir):
    """The last of three points against the first."""
    w = Window.partitionBy("event_type")
    rows = _daily(spark, sf_dir).withColumns({"before": F.lag("n", 2).over(w.orderBy("day")), "place": F.row_number().over(w.orderBy(F.desc("day")))}).where("place = 1")
    return rows.select("event_type", "day", F.when(F.col("before").isNull(), "-").when(F.col("n") > F.col("before"), "up").when(F.col("n") < F.col("before"), "down").otherwise("flat").alias("arrow"))


@query("""
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS p FROM events)
SELECT event_type, count(*) AS runs, round(avg(value), 6) AS mean, round(max(value), 6) AS most FROM r WHERE p <= 20 GROUP BY event_type
""")
def last_runs(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("ts"), F.desc("event_id")))
    rows = _events(spark, sf_dir).withColumn("p", place).where("p <= 20")
    return rows.groupBy("event_type").agg(F.count("*").alias("runs"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.max("value"), 6).alias("most"))


@query("""
SELECT user_id, event_type, count(*) AS runs, count(*) FILTER (value < 1) AS failed, round(count(*) FILTER (value < 1) / count(*), 6) AS rate FROM events GROUP BY ALL HAVING count(*) FILTER (value < 1) > 0 AND count(*) FILTER (value >= 1) > 0
""")
def flaky_entities(spark, sf_dir):
    """What has both passed and failed (a value below 1 is a failure)."""
    rows = _events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count("*").alias("runs"), F.count_if(F.col("value") < 1).alias("failed"))
    return rows.where("failed > 0 AND failed < runs").withColumn("rate", F.round(F.col("failed") / F.col("runs"), 6))


@query("""
SELECT user_id, count(*) AS runs, round(avg(value), 6) AS mean, round(max(value), 6) AS most FROM events WHERE event_type <> 'error' GROUP BY user_id ORDER BY round(avg(value), 6) DESC, user_id LIMIT 10
""")
def slowest_entities(spark, sf_dir):
    rows = _events(spark, sf_dir).where("event_type != 'error'").groupBy("user_id").agg(F.count("*").alias("runs"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.max("value"), 6).alias("most"))
    return rows.orderBy(F.desc("mean"), "user_id").limit(10)


@query("""
WITH k AS (SELECT event_type AS kind, CASE WHEN value > 100 THEN 'high' ELSE 'low' END AS severity, count(*) AS n FROM events GROUP BY ALL),
t AS (SELECT count(*) AS total, greatest(count(DISTINCT date_trunc('hour', ts)), 1) AS sessions FROM events)
SELECT kind, severity, n, total, sessions, round(total / sessions, 6) AS per_session FROM k, t
""")
def violation_summary(spark, sf_dir):
    """Counts by kind and severity; hours with any count as sessions."""
    e = _events(spark, sf_dir)
    total = e.agg(F.count("*").alias("total"), F.greatest(F.countDistinct(F.date_trunc("hour", "ts")), F.lit(1)).alias("sessions"))
    rows = e.groupBy(F.col("event_type").alias("kind"), F.when(F.col("value") > 100, "high").otherwise("low").alias("severity")).agg(F.count("*").alias("n"))
    return rows.join(F.broadcast(total)).withColumn("per_session", F.round(F.col("total") / F.col("sessions"), 6))


@query("""
WITH t AS (SELECT max(ts) AS as_of FROM events), r AS (SELECT e.* FROM events e, t WHERE event_type = 'error' AND ts > as_of - INTERVAL 24 HOURS)
SELECT count(*) AS n, (SELECT string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) FROM (SELECT * FROM r ORDER BY ts DESC, event_id DESC LIMIT 3)) AS last FROM r
""")
def error_summary(spark, sf_dir):
    """Errors of the last day, and the last three."""
    e = _events(spark, sf_dir)
    rows = e.where("event_type = 'error'").join(F.broadcast(e.agg(F.max("ts").alias("as_of")))).where(F.col("ts") > F.col("as_of") - F.expr("INTERVAL 24 HOURS"))
    last = rows.select("ts", "event_id").orderBy(F.desc("ts"), F.desc("event_id")).limit(3).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda s: s["event_id"].cast("string")), ",").alias("last"))
    return rows.agg(F.count("*").alias("n")).join(F.broadcast(last))


@query("SELECT user_id, count(*) AS observations, count(*) FILTER (value >= 100) AS confident, count(*) >= 3 AND count(*) FILTER (value >= 100) / count(*) >= 0.5 AS ready FROM events GROUP BY user_id")
def experiment_readiness(spark, sf_dir):
    """Three observations and more, half of them confident."""
    n, sure = F.count("*"), F.count_if(F.col("value") >= 100)
    return _events(spark, sf_dir).groupBy("user_id").agg(n.alias("observations"), sure.alias("confident"), ((n >= 3) & (sure / n >= 0.5)).alias("ready"))


@query("""
WITH f AS (SELECT user_id, min(struct_pack(ts := ts, id := event_id)) AS f FROM events WHERE event_type = 'view' GROUP BY user_id)
SELECT e.user_id, count(*) AS n, count(*) FILTER (f IS NULL OR struct_pack(ts := ts, id := event_id) <= f) AS without_first FROM events e LEFT JOIN f USING (user_id) WHERE event_type = 'purchase' GROUP BY e.user_id
""")
def open_after_close_precedence(spark, sf_dir):
    """Purchases without an earlier view of the same user."""
    return U.precedence(_events(spark, sf_dir), "user_id", F.col("event_type") == "view", F.col("event_type") == "purchase")


@query("""
WITH a AS (SELECT user_id, date_trunc('day', ts) AS day, list_sort(list(DISTINCT event_type)) AS kinds FROM events GROUP BY ALL),
p AS (SELECT x.k AS a, y.k AS b FROM (SELECT user_id, day, unnest(kinds) AS k FROM a) x JOIN (SELECT user_id, day, unnest(kinds) AS k FROM a) y ON x.user_id = y.user_id AND x.day = y.day AND x.k < y.k),
n AS (SELECT k, count(*) AS n FROM (SELECT unnest(kinds) AS k FROM a) GROUP BY k),
c AS (SELECT a, b, count(*) AS together FROM p GROUP BY ALL)
SELECT a, b, together, x.n + y.n - together AS either, round(together / (x.n + y.n - together), 6) AS ratio, x.n + y.n - together >= 10 AND together / (x.n + y.n - together) >= 0.9 AS merge FROM c JOIN n x ON x.k = a JOIN n y ON y.k = b
""")
def co_activation_pairs(spark, sf_dir):
    """Pairs of types of the same user and day: how often both, how often either; candidates for a merge."""
    from ..operators.rules import co_activations

    rows = _events(spark, sf_dir).select("user_id", F.date_trunc("day", "ts").alias("day"), "event_type")
    return co_activations(rows, ["user_id", "day"], "event_type")


@query("""
WITH m(category, hypothesis) AS (VALUES ('view', CAST(20 AS DOUBLE)), ('click', 45), ('error', 5), ('purchase', 20)), n AS (SELECT count(*) AS total FROM events),
c AS (SELECT event_type AS category, count(*) AS n FROM events GROUP BY 1)
SELECT category, hypothesis, round(100 * coalesce(c.n, 0) / total, 4) AS actual, round(100 * coalesce(c.n, 0) / total - hypothesis, 4) AS delta, CASE WHEN abs(100 * coalesce(c.n, 0) / total - hypothesis) <= 10 THEN 'confirmed' WHEN 100 * coalesce(c.n, 0) / total > hypothesis THEN 'above' ELSE 'below' END AS verdict FROM m LEFT JOIN c USING (category), n
""")
def hypothesis_vs_actual(spark, sf_dir):
    """Expected shares against counted ones, within ten points."""
    e = _events(spark, sf_dir)
    counts = e.groupBy(F.col("event_type").alias("category")).agg(F.count("*").alias("n"))
    want = spark.createDataFrame([("view", 20.0), ("click", 45.0), ("error", 5.0), ("purchase", 20.0)], "category string, hypothesis double")
    rows = want.join(counts, "category", "left").join(F.broadcast(e.agg(F.count("*").alias("total"))))
    actual = 100 * F.coalesce("n", F.lit(0)) / F.col("total")
    delta = actual - F.col("hypothesis")
    return rows.select("category", "hypothesis", F.round(actual, 4).alias("actual"), F.round(delta, 4).alias("delta"), F.when(F.abs(delta) <= 10, "confirmed").when(delta > 0, "above").otherwise("below").alias("verdict"))


@query(f"""
{_DAILY}, s AS (SELECT event_type, n, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS p FROM d)
SELECT event_type, max(n) FILTER (p = 2) AS baseline, max(n) FILTER (p = 1) AS latest, CASE WHEN max(n) FILTER (p = 1) > max(n) FILTER (p = 2) THEN 'IMPROVED' WHEN max(n) FILTER (p = 1) < max(n) FILTER (p = 2) THEN 'DEGRADED' ELSE 'UNCHANGED' END AS change FROM s GROUP BY event_type
""")
def baseline_diff(spark, sf_dir):
    """The latest snapshot against the one before."""
    rows = _daily(spark, sf_dir).withColumn("p", F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("day"))))
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("n")))
    out = rows.groupBy("event_type").agg(at(2).alias("baseline"), at(1).alias("latest"))
    return out.withColumn("change", F.when(F.col("latest") > F.col("baseline"), "IMPROVED").when(F.col("latest") < F.col("baseline"), "DEGRADED").otherwise("UNCHANGED"))


@query("""
WITH f(metric, least) AS (VALUES ('documents', CAST(100 AS BIGINT)), ('events', 1000), ('pages', 10), ('labels', 100000000)),
v AS (SELECT 'documents' AS metric, count(*) AS value FROM documents UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'labels', count(*) FROM labels)
SELECT metric, value, least, CASE WHEN value = 0 THEN 'instrumented' WHEN value < least THEN 'below floor' ELSE 'spinning' END AS status FROM v JOIN f USING (metric)
""")
def loop_health(spark, sf_dir):
    """Metrics against their floors."""
    floors = {"documents": 100, "events": 1000, "pages": 10, "labels": 100000000}
    rows = None
    for name, least in floors.items():
        one = table(spark, sf_dir, name).agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value", F.lit(least).cast("long").alias("least"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.withColumn("status", F.when(F.col("value") == 0, "instrumented").when(F.col("value") < F.col("least"), "below floor").otherwise("spinning"))


@query("""
WITH c AS (SELECT source, count(*) AS actual FROM documents GROUP BY source), s(source, stated) AS (VALUES ('src0', CAST(50 AS BIGINT)), ('src1', 49), ('src2', 10), ('src99', 3))
SELECT source, stated, coalesce(actual, 0) AS actual, CASE WHEN actual IS NULL THEN 'ERROR' WHEN abs(stated - actual) <= 2 THEN 'OK' WHEN abs(stated - actual) <= 10 THEN 'WARNING' ELSE 'ERROR' END AS severity FROM s LEFT JOIN c USING (source)
""")
def stated_vs_actual_counts(spark, sf_dir):
    """Counts that documents state against those found, with a tolerance."""
    actual = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("actual"))
    stated = spark.createDataFrame([("src0", 50), ("src1", 49), ("src2", 10), ("src99", 3)], "source string, stated long")
    diff = F.abs(F.col("stated") - F.col("actual"))
    return stated.join(actual, "source", "left").select("source", "stated", F.coalesce("actual", F.lit(0)).alias("actual"), F.when(F.col("actual").isNull(), "ERROR").when(diff <= 2, "OK").when(diff <= 10, "WARNING").otherwise("ERROR").alias("severity"))


@query("""
WITH a AS (SELECT source, lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY ALL)
SELECT count(*) AS checks, count(*) FILTER (n < 2) AS errors, count(*) FILTER (n >= 2 AND n < 5) AS warnings, bool_or(n < 2) AS failed, CASE WHEN count(*) FILTER (n < 2) > 0 THEN 'FAIL' WHEN count(*) FILTER (n < 5) > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM a
""")
def issue_summary(spark, sf_dir):
    """Checks by severity, and the worst verdict."""
    rows = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return rows.agg(F.count("*").alias("checks"), F.count_if(F.col("n") < 2).alias("errors"), F.count_if((F.col("n") >= 2) & (F.col("n") < 5)).alias("warnings"), F.bool_or(F.col("n") < 2).alias("failed"), F.when(F.count_if(F.col("n") < 2) > 0, "FAIL").when(F.count_if(F.col("n") < 5) > 0, "WARN").otherwise("PASS").alias("verdict"))


@query("""
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source), caps(source, cap) AS (VALUES ('src0', CAST(10 AS BIGINT)), ('src1', 100), ('src2', 50))
SELECT source, n, cap, n > cap + 1 AS blocked FROM c JOIN caps USING (source)
""")
def cap_gate(spark, sf_dir):
    """Counts against caps; one more than the cap may pass."""
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    caps = spark.createDataFrame([("src0", 10), ("src1", 100), ("src2", 50)], "source string, cap long")
    return counts.join(F.broadcast(caps), "source").withColumn("blocked", F.col("n") > F.col("cap") + 1)


@query("""
WITH r AS (SELECT doc_id, [doc_id % 7, doc_id % 11, 100 + doc_id % 3] AS refs FROM documents), k AS (SELECT doc_id AS id FROM labels),
e AS (SELECT doc_id, unnest(refs) AS ref FROM r), m AS (SELECT doc_id, count(*) AS refs, count(k.id) AS known FROM (SELECT DISTINCT * FROM e) LEFT JOIN k ON k.id = ref GROUP BY doc_id)
SELECT doc_id, refs, known, CASE WHEN known = 0 THEN 'missing' WHEN known < refs THEN 'partial' ELSE 'covered' END AS coverage FROM m
""")
def reference_coverage(spark, sf_dir):
    """How many of the identifiers that a row refers to exist."""
    refs = F.array_distinct(F.array(F.col("doc_id") % 7, F.col("doc_id") % 11, 100 + F.col("doc_id") % 3))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(refs).alias("ref"))
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ref"), F.lit(1).alias("k"))
    out = rows.join(known, "ref", "left").groupBy("doc_id").agg(F.count("*").alias("refs"), F.count("k").alias("known"))
    return out.withColumn("coverage", F.when(F.col("known") == 0, "missing").when(F.col("known") < F.col("refs"), "partial").otherwise("covered"))
