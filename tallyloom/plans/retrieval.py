"""Queries that match, extract and gate: words and phrases, quotes, flags, topics, warnings, tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus as C
from ..operators import extraction as E
from ..sources import html as H
from .registry import query, table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _word(entry: str) -> str:
    parts = entry.rstrip("*").split()
    return "regexp_matches(lower(coalesce(text, '')), '(^|[^a-z0-9])" + "[^a-z0-9]+".join(parts) + ("" if entry.endswith("*") else "([^a-z0-9]|$)") + "')"


@query(f"SELECT doc_id, source FROM documents WHERE {_word('the')} AND ({_word('and the')} OR {_word('ther*')}) AND NOT {_word('thing')}")
def boolean_match(spark, sf_dir):
    """A word, one of a phrase and a beginning, and none of another word."""
    return _docs(spark, sf_dir).where(E.holds(F.col("text"), ["the"], ["and the", "ther*"], ["thing"])).select("doc_id", "source")


@query("""
WITH f AS (SELECT doc_id, (CASE WHEN contains(lower(text), 'thing') THEN 1.0 ELSE 0 END + CASE WHEN contains(lower(text), 'ering') THEN 0.5 ELSE 0 END)::DOUBLE AS m, (1 + doc_id % 3)::DOUBLE AS w FROM documents),
p AS (SELECT *, row_number() OVER (ORDER BY m * w DESC, doc_id) AS pre FROM f WHERE m > 0)
SELECT doc_id, CASE WHEN pre <= 20 THEN 0 ELSE 1 END AS bucket, CASE WHEN pre <= 20 THEN m * 0.8::DOUBLE ELSE m * w END AS score FROM p
""")
def ranked_with_rest(spark, sf_dir):
    """The first twenty scored anew, the rest in the order that chose them."""
    terms = {"thing": 1.0, "ering": 0.5}
    return C.ranked_all(_docs(spark, sf_dir), terms, (1 + F.col("doc_id") % 3).cast("double"), F.lit(0.8))


_ITEMS = r"'run `tool ' || (doc_id % 3) || '` and `tool 1` in /a/b' || doc_id || '.txt, 50 tokens or 20 messages. '"


@query(rf"""
WITH d AS (SELECT doc_id, {_ITEMS} || regexp_replace(coalesce(text, ''), '[`/0-9]', ' ', 'g') AS t FROM documents)
SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '`([^`]+)`', 1))), '|') AS commands, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '/[a-z]+/[a-z0-9.]+'))), '|') AS paths, array_to_string(list_sort(list_distinct(regexp_extract_all(t, '[0-9]+ (?:tokens|messages)'))), '|') AS quotas FROM d
""")
def extracted_items(spark, sf_dir):
    """Commands, paths and quotas of texts that begin with some."""
    top = F.concat(F.lit("run `tool "), F.col("doc_id") % 3, F.lit("` and `tool 1` in /a/b"), "doc_id", F.lit(".txt, 50 tokens or 20 messages. "))
    rows = _docs(spark, sf_dir).select("doc_id", F.concat(top, F.regexp_replace(F.coalesce("text", F.lit("")), "[`/0-9]", " ")).alias("t"))
    of = lambda p, g=0: F.array_join(F.sort_array(E.extracted(F.col("t"), p, g)), "|")
    return rows.select("doc_id", of("`([^`]+)`", 1).alias("commands"), of("/[a-z]+/[a-z0-9.]+").alias("paths"), of("[0-9]+ (?:tokens|messages)").alias("quotas"))


_FLAGS = {"things": "(?i)things?", "numbers": "[0-9]{3,}", "questions": "[?]", "licences": "(?i)licens|copyright"}


@query("SELECT source, " + ", ".join(f"count(*) FILTER (regexp_matches(text, '{p}')) AS {n}" for n, p in _FLAGS.items()) + " FROM documents GROUP BY source")
def topic_flags(spark, sf_dir):
    return _docs(spark, sf_dir).groupBy("source").agg(*[F.count_if(c).alias(n) for n, c in E.flags(F.col("text"), _FLAGS).items()])


_QUOTES = (r"(?is)(?:the|thing)[^.]{10,150}and[^.]{5,100}[.]", r"(?is)(?:other|ther)[^.]{10,150}ing[^.]{5,100}[.]")


@query(rf"""
WITH q AS (SELECT doc_id, list_filter(list_transform(list_concat({", ".join(f"regexp_extract_all(text, '{p}')" for p in _QUOTES)}), lambda x: regexp_replace(trim(x), '\s+', ' ', 'g')), lambda x: length(x) > 50 AND length(x) < 250)[1:15] AS q FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(len(q) AS BIGINT) AS n, md5(array_to_string(q, '|')) AS quotes FROM q WHERE len(q) > 0
""")
def key_quotes(spark, sf_dir):
    rows = _docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", E.key_quotes(F.col("text"), _QUOTES).alias("q"))
    return rows.where(F.size("q") > 0).select("doc_id", F.size("q").cast("long").alias("n"), F.md5(F.array_join("q", "|")).alias("quotes"))


_SETS = {"things": ("thing", "object"), "others": ("other", "another"), "ends": ("ention", "ation")}


@query("""
WITH c AS (SELECT doc_id, list_filter(['things', 'others', 'ends'], lambda k: CASE k WHEN 'things' THEN contains(l, 'thing') OR contains(l, 'object') WHEN 'others' THEN contains(l, 'other') OR contains(l, 'another') ELSE contains(l, 'ention') OR contains(l, 'ation') END) AS c FROM (SELECT doc_id, lower(coalesce(text, '')) AS l FROM documents))
SELECT k AS category, count(*) AS docs FROM (SELECT unnest(CASE WHEN len(c) = 0 THEN ['other'] ELSE c END) AS k FROM c) GROUP BY k
""")
def strategy_categories(spark, sf_dir):
    return _docs(spark, sf_dir).select(F.explode(E.categories(F.col("text"), _SETS)).alias("category")).groupBy("category").agg(F.count("*").alias("docs"))


@query("""
WITH t AS (SELECT DISTINCT left(string_split(text, chr(10))[1], 40) AS topic FROM documents WHERE text IS NOT NULL),
s AS (SELECT topic, CAST(contains(lower(topic), 'the') AS BIGINT) + CAST(contains(lower(topic), 'and') AS BIGINT) + CAST(contains(lower(topic), 'ing') AS BIGINT) AS score FROM t)
SELECT * FROM s WHERE score > 0 ORDER BY score DESC, topic LIMIT 3
""")
def topic_lookup(spark, sf_dir):
    """Of the first lines' beginnings, the three that hold the most terms."""
    index = _docs(spark, sf_dir).where("text IS NOT NULL").select(F.left(F.split("text", "\n")[0], F.lit(40)).alias("topic")).distinct()
    return E.topics(index, ("the", "and", "ing"))


@query("""
WITH g AS (SELECT source, count(*) AS articles, count(*) FILTER (contains(lower(text), 'thing') AND length(text) > 3000) AS hits FROM documents GROUP BY source)
SELECT *, CASE WHEN articles < 25 THEN CASE WHEN hits < 3 THEN 'small, low confidence' ELSE 'small' END WHEN hits < 3 THEN 'low confidence' ELSE '' END AS warning FROM g
""")
def answer_warnings(spark, sf_dir):
    hit = F.lower("text").contains("thing") & (F.length("text") > 3000)
    return E.confidence(_docs(spark, sf_dir), "source", hit)


@query("""
WITH l AS (SELECT CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines FROM documents WHERE text IS NOT NULL)
SELECT CASE WHEN lines < 5 THEN 'lean' WHEN lines < 12 THEN 'medium' ELSE 'heavy' END AS tier, count(*) AS texts, CAST(sum(lines) AS BIGINT) AS lines, round(avg(lines), 6) AS mean_lines FROM l GROUP BY ROLLUP (1)
""")
def audit_tiers(spark, sf_dir):
    return E.audit(_docs(spark, sf_dir), (("lean", 5), ("medium", 12)), "heavy")


@query("""
SELECT CASE WHEN doc_id % 4 = 0 THEN 'Unknown' ELSE lang END AS lang, coalesce(source, 'none') AS source, CASE WHEN doc_id % 3 = 0 THEN '{"doc_id":"' || doc_id || '"}' ELSE '{"doc_id":"' || doc_id || '","n_chars":"' || n_chars || '"}' END AS extras FROM documents WHERE lang IS NOT NULL
""")
def coerced_rows(spark, sf_dir):
    """Defaults for what is missing, the other fields as JSON."""
    docs = _docs(spark, sf_dir).where("lang IS NOT NULL").select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.lit("  ")).otherwise(F.col("lang")).alias("lang"), "source", F.when(F.col("doc_id") % 3 != 0, F.col("n_chars")).alias("n_chars"))
    return E.coerced(docs, {"lang": "Unknown", "source": "none"}, ("doc_id", "n_chars"))


@query("""
WITH m AS (SELECT DISTINCT user_id AS a, user_id + 1 AS b, user_id % 41 AS l, user_id % 17 AS days FROM events), c AS (SELECT a, b, greatest(0, least(l, 30) - days) AS "left" FROM m)
SELECT a, b, CAST("left" AS BIGINT) AS "left", "left" = 0 AS free FROM c
""")
def cooldown_tick(spark, sf_dir):
    """Pairs whose merge was undone, some days later."""
    merges = table(spark, sf_dir, "events").select(F.col("user_id").alias("a"), (F.col("user_id") + 1).alias("b"), (F.col("user_id") % 41).alias("left"), (F.col("user_id") % 17).alias("days")).distinct()
    return E.cooled(merges, F.col("days"))


_HOST = "regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '^www[.]', '')"


@query(f"""
WITH h AS (SELECT {_HOST} AS host, max(page_id) AS last_page, CASE WHEN max(page_id) % 4 = 0 THEN 'DOWN' ELSE 'UP' END AS status FROM pages GROUP BY 1)
SELECT host, status, last_page, row_number() OVER (ORDER BY status, host) AS place FROM h QUALIFY place <= 50
""")
def source_heartbeat(spark, sf_dir):
    """Hosts by their last page; those that are down come first."""
    from pyspark.sql import Window

    hosts = table(spark, sf_dir, "pages").groupBy(H.host(F.col("url")).alias("host")).agg(F.max("page_id").alias("last_page"))
    first = hosts.withColumn("status", F.when(F.col("last_page") % 4 == 0, "DOWN").otherwise("UP")).orderBy("status", "host").limit(50)
    return first.select("host", "status", "last_page", F.row_number().over(Window.orderBy("status", "host")).cast("long").alias("place"))


@query("SELECT count(*) AS n FROM pages WHERE starts_with(url, 'https://www')")
def prefix_count(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(F.col("url").startswith("https://www")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def newest_first(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(25)


@query("SELECT source AS name FROM documents UNION SELECT role FROM conversations UNION SELECT event_type FROM events")
def union_of_names(spark, sf_dir):
    name = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("name"))
    return name("documents", "source").unionByName(name("conversations", "role")).unionByName(name("events", "event_type")).distinct()


@query("""
SELECT 'documents' AS panel, 'total' AS measure, CAST(count(*) AS DOUBLE) AS value FROM documents
UNION ALL SELECT 'documents', 'source:' || source, count(*) FROM documents GROUP BY source
UNION ALL SELECT 'events', 'type:' || event_type, count(*) FROM events GROUP BY event_type
UNION ALL SELECT 'events', 'errors', count(*) FILTER (event_type = 'error') FROM events
UNION ALL SELECT 'labels', 'toxic', coalesce(sum(toxic), 0) FROM labels
""")
def dashboard_payload(spark, sf_dir):
    """All panels' numbers as rows, each table read once."""
    one = lambda rows, panel: rows.select(F.lit(panel).alias("panel"), "measure", F.col("value").cast("double").alias("value"))
    docs = _docs(spark, sf_dir).rollup("source").agg(F.count("*").alias("value"), F.grouping("source").alias("all")).where("all = 1 OR source IS NOT NULL")
    events = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("value"))
    errors = events.agg(F.coalesce(F.sum(F.when(F.col("event_type") == "error", F.col("value"))), F.lit(0)).alias("value"))
    toxic = table(spark, sf_dir, "labels").agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("value"))
    return (
        one(docs.withColumn("measure", F.when(F.col("all") == 1, "total").otherwise(F.concat(F.lit("source:"), "source"))), "documents")
        .unionByName(one(events.withColumn("measure", F.concat(F.lit("type:"), "event_type")), "events"))
        .unionByName(one(errors.withColumn("measure", F.lit("errors")), "events"))
        .unionByName(one(toxic.withColumn("measure", F.lit("toxic")), "labels"))
    )


@query("""
WITH s AS (SELECT source, count(*) AS docs, round(avg(length(text)), 6) AS mean_chars, max(doc_id) AS newest FROM documents GROUP BY source)
SELECT *, CASE WHEN mean_chars >= 5000 THEN 'deep' WHEN mean_chars >= 1500 THEN 'medium' ELSE 'thin' END AS density, newest % 60 > 30 AS stale FROM s
""")
def source_health(spark, sf_dir):
    """By source: size, density and whether nothing came for thirty days (here: by the newest number)."""
    rows = _docs(spark, sf_dir).groupBy("source").agg(F.count("*").alias("docs"), F.round(F.avg(F.length("text")), 6).alias("mean_chars"), F.max("doc_id").alias("newest"))
    density = F.when(F.col("mean_chars") >= 5000, "deep").when(F.col("mean_chars") >= 1500, "medium").otherwise("thin")
    return rows.select("*", density.alias("density"), (F.col("newest") % 60 > 30).alias("stale"))
