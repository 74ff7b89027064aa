"""Queries on texts as they stand in files: articles, session records, subtitles, boards, experiments. The tables' rows are put into the files' form, then read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import checks as K
from ..operators import rules as R
from ..operators import texts as T
from ..sources import articles as A
from ..sources import logs as L
from ..sources import sinks
from ..sources import subtitles as S
from ..streaming import streams
from .registry import query, table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text IS NOT NULL")


_WORDS = "len(list_filter(string_split_regex({}, '[ \\t\\n\\f\\r]+'), lambda x: x <> ''))"


@query(rf"""
WITH d AS (SELECT *, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body FROM documents WHERE text IS NOT NULL)
SELECT doc_id, source AS key, source || ': ' || doc_id AS title, lang AS author, source || '|' || lang AS tags, '{{"level":"' || (doc_id % 7) || '"}}' AS extras, CAST({_WORDS.format("body")} AS BIGINT) AS words, md5(body) AS content_hash FROM d WHERE lang IS NOT NULL
""")
def parsed_articles(spark, sf_dir):
    """A block of fields between rules, then the body."""
    block = F.concat(F.lit('---\ntitle: "'), "source", F.lit(": "), "doc_id", F.lit('"\nauthor: '), "lang", F.lit("\ntags: ["), "source", F.lit(', "'), "lang", F.lit('"]\nlevel: '), F.col("doc_id") % 7, F.lit("\n---\n\n"), "text")
    files = _docs(spark, sf_dir).where("lang IS NOT NULL").select(F.concat(F.lit("/kb/"), "source", F.lit("/articles/"), "doc_id", F.lit(".md")).alias("path"), block.alias("text"))
    rows = A.parsed(files)
    return rows.select(F.regexp_extract("path", "([0-9]+)[.]md$", 1).cast("long").alias("doc_id"), A.source_key(F.col("path")).alias("key"), "title", "author", F.array_join("tags", "|").alias("tags"), "extras", "words", "content_hash")


@query(rf"""
SELECT doc_id, 'T' || doc_id AS title, source AS author, '2024-01-0' || (1 + doc_id % 9) AS date, 'http://x.example/' || doc_id AS url, CAST({_WORDS.format("text")} AS BIGINT) AS words FROM documents WHERE text IS NOT NULL
""")
def header_articles(spark, sf_dir):
    """A title and bold fields above a rule."""
    top = F.concat(F.lit("# T"), "doc_id", F.lit("\n**Author:** "), "source", F.lit("\n**Date:** 2024-01-0"), 1 + F.col("doc_id") % 9, F.lit("\n**URL:** http://x.example/"), "doc_id", F.lit("\n\n---\n"), "text")
    rows = A.parsed(_docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("path"), top.alias("text")))
    return rows.select(F.col("path").cast("long").alias("doc_id"), "title", "author", "date", "url", "words")


@query("""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, l, unnest(range(0, (len(l) + 2) // 3)) AS g FROM l),
t AS (SELECT doc_id, g, trim(left(l[3 * g + 1], 20)) AS heading, l[3 * g + 2] AS a, l[3 * g + 3] AS b FROM g),
x AS (SELECT doc_id, g, heading, CASE WHEN a IS NULL THEN '' WHEN b IS NULL THEN a WHEN a = '' THEN b ELSE a || chr(10) || b END AS text FROM t)
SELECT doc_id, CAST(g + 1 AS BIGINT) AS section, CAST(2 AS BIGINT) AS level, heading, md5(text) AS text, CAST(greatest(1, floor(length(text) / 3.8)) AS BIGINT) AS tokens FROM x
""")
def article_sections(spark, sf_dir):
    """Each third line is a heading."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 3 == 0, F.concat(F.lit("## "), F.left(x, F.lit(20)))).otherwise(x))
    rows = A.sections(_docs(spark, sf_dir).select(F.col("doc_id").alias("path"), F.array_join(lines, "\n").alias("text")))
    return rows.select(F.col("path").alias("doc_id"), F.col("section").cast("long").alias("section"), F.col("level").cast("long").alias("level"), "heading", F.md5("text").alias("text"), F.col("tokens").cast("long").alias("tokens"))


@query("SELECT event_type AS type, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE event_id % 10 <> 0 GROUP BY event_type")
def well_formed_lines(spark, sf_dir):
    """JSON lines, each tenth of which breaks off."""
    whole = F.to_json(F.struct(F.col("event_type").alias("type"), "value"))
    rows = table(spark, sf_dir, "events").select(F.lit("a.jsonl").alias("path"), F.col("event_id").alias("line"), F.when(F.col("event_id") % 10 == 0, F.left(whole, F.length(whole) - 3)).otherwise(whole).alias("value"))
    return L.parsed_lines(rows, "type string, value double").groupBy("type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def _records(spark, sf_dir):
    """Events as session records: a file for each user, those of every fifth below a folder of sub-agents."""
    n = lambda k: (F.col("event_id") % k).cast("long")
    usage = F.struct(n(100).alias("input_tokens"), n(50).alias("output_tokens"), n(7).alias("cache_creation_input_tokens"), n(11).alias("cache_read_input_tokens"))
    message = F.struct(F.lit("assistant").alias("role"), F.concat(F.lit("m"), F.col("event_id") % 3).alias("model"), F.lit("").alias("content"), usage.alias("usage"))
    path = F.concat(F.lit("/s/"), F.when(F.col("user_id") % 5 == 0, F.lit("subagents/")).otherwise(F.lit("")), "user_id")
    return table(spark, sf_dir, "events").select(path.alias("path"), F.col("event_id").alias("line"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), message.alias("message"))


_SUMS = "CAST(sum(event_id % 100) AS BIGINT) AS {}, CAST(sum(event_id % 50) AS BIGINT) AS {}, CAST(sum(event_id % 7) AS BIGINT) AS {}, CAST(sum(event_id % 11) AS BIGINT) AS {}"


@query(f"""
SELECT '/s/' || user_id AS path, strftime(arg_min(ts, event_id), '%Y-%m-%d %H:%M:%S') AS start, strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S') AS "end", arg_min('m' || (event_id % 3), event_id) AS model,
  count(*) FILTER (event_id % 100 + event_id % 50 + event_id % 7 + event_id % 11 > 0) AS calls, {_SUMS.format("input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens")}
FROM events WHERE user_id % 5 <> 0 GROUP BY user_id
""")
def session_tokens(spark, sf_dir):
    rows = L.sessions(_records(spark, sf_dir))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return rows.select("path", text("start"), text("end"), *rows.columns[3:])


@query(f"SELECT '/s/' || CASE WHEN user_id % 5 = 0 THEN 'subagents/' ELSE '' END || user_id AS path, 'm' || (event_id % 3) AS model, count(*) AS calls, {_SUMS.format('input', 'output', 'cache_write', 'cache_read')} FROM events GROUP BY ALL")
def session_models(spark, sf_dir):
    return L.by_model(_records(spark, sf_dir))


@query("""
SELECT conv_id, turn, CAST(0 AS BIGINT) AS pos, role, 'text' AS kind, NULL AS name, NULL AS target, CAST(length(text) AS BIGINT) AS chars, FALSE AS error FROM conversations
UNION ALL SELECT conv_id, turn, 1, role, 'tool', 'Read', '/f/' || turn, NULL, FALSE FROM conversations
UNION ALL SELECT conv_id, turn, 2, role, 'result', NULL, NULL, 2, turn % 2 = 1 FROM conversations
""")
def content_blocks(spark, sf_dir):
    """Turns as lists of blocks in JSON: a text, a tool's use, its result."""
    none = F.lit(None).cast("string")
    block = lambda type_, text=none, name=none, input_=F.lit(None).cast("map<string,string>"), content=none, error=F.lit(None).cast("boolean"): F.struct(F.lit(type_).alias("type"), text.alias("text"), name.alias("name"), input_.alias("input"), content.alias("content"), error.alias("is_error"))
    turns = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    content = F.to_json(F.array(block("text", F.col("text")), block("tool_use", name=F.lit("Read"), input_=F.create_map(F.lit("file_path"), F.concat(F.lit("/f/"), "turn"))), block("tool_result", content=F.lit("ok"), error=F.col("turn") % 2 == 1)))
    rows = L.blocks(turns.select(F.col("conv_id").alias("path"), F.col("turn").alias("line"), F.struct("role", content.alias("content")).alias("message")))
    return rows.select(F.col("path").alias("conv_id"), F.col("line").alias("turn"), F.col("pos").cast("long").alias("pos"), "role", "kind", "name", "target", F.length("text").cast("long").alias("chars"), "error")


@query(r"""
WITH l AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)), t AS (SELECT doc_id, i, trim(regexp_replace(x, '<[^>]+>', '', 'g')) AS line FROM l)
SELECT doc_id, line, CAST(min(4 + 4 * i) AS BIGINT) AS pos FROM t WHERE line <> '' AND NOT regexp_matches(line, '^(WEBVTT|NOTE|STYLE|Kind:|Language:)') AND NOT regexp_matches(line, '^[0-9]+$') AND NOT contains(line, '-->') AND NOT regexp_matches(line, '^\[[^\]]*\]$') GROUP BY doc_id, line
""")
def subtitle_lines(spark, sf_dir):
    """Lines as cues with numbers, times and tags."""
    time = lambda i: F.concat(F.lit("00:00:"), F.lpad(i.cast("string"), 2, "0"), F.lit(".000"))
    cues = F.transform(F.split("text", "\n"), lambda x, i: F.concat((i + 1).cast("string"), F.lit("\n"), time(i), F.lit(" --> "), time(i + 1), F.lit("\n<c>"), x, F.lit("</c>\n")))
    rows = S.spoken(_docs(spark, sf_dir).select(F.col("doc_id").alias("path"), F.concat(F.lit("WEBVTT\n\n"), F.array_join(cues, "\n")).alias("text")))
    return rows.select(F.col("path").alias("doc_id"), "line", F.col("pos").cast("long").alias("pos"))


def _boards(spark, sf_dir):
    line = F.when(F.col("turn") % 4 == 0, F.lit("## In progress")).otherwise(F.concat(F.lit("- **t"), "turn", F.lit("** "), F.element_at(F.array(F.lit("blocked"), F.lit("item"), F.lit("done")), (F.col("turn") % 4).cast("int"))))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", line.alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n")
    return rows.groupBy(F.col("conv_id").alias("path")).agg(text.alias("text"))


_BOARDS = """
WITH r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations), h AS (SELECT *, count(*) FILTER (turn % 4 = 0) OVER (PARTITION BY conv_id ORDER BY pos) > 0 AS headed FROM r),
s AS (SELECT conv_id, pos, CASE WHEN headed THEN 'In progress' END AS section, 't' || turn AS name, CASE turn % 4 WHEN 1 THEN 1 WHEN 2 THEN CASE WHEN headed THEN 2 ELSE 3 END ELSE 4 END AS rank FROM h WHERE turn % 4 <> 0),
b AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY rank, pos) AS place, section, name, ['BLOCKED', 'IN PROGRESS', 'NEXT', 'DONE'][rank] AS status FROM s QUALIFY place <= 10)
"""


@query(_BOARDS + "SELECT * FROM b")
def task_boards(spark, sf_dir):
    """Turns as lines of boards: headings, and blocked, other and done tasks."""
    rows = K.tasks(_boards(spark, sf_dir))
    return rows.select(F.col("path").alias("conv_id"), F.col("place").cast("long").alias("place"), "section", "name", "status")


@query(_BOARDS + "SELECT conv_id, arg_min(name, place) AS name, arg_min(status, place) AS status FROM b WHERE status <> 'DONE' GROUP BY conv_id")
def next_actions(spark, sf_dir):
    return K.next_action(K.tasks(_boards(spark, sf_dir))).withColumnRenamed("path", "conv_id")


@query(r"""
SELECT doc_id, md5(source || ' ' || text) AS plain, source || chr(10) || lang || ' is' || chr(10) || 'item' AS cleaned, trim(left(text, 50)) AS unfenced FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL
""")
def cleaned_texts(spark, sf_dir):
    """Wiki links, marks of Markdown and fences taken off again."""
    marked = F.concat(F.lit("# "), "source", F.lit("\n**"), "lang", F.lit("** *is*\n---\n- item"))
    return (
        _docs(spark, sf_dir)
        .where("lang IS NOT NULL")
        .select(
            "doc_id",
            F.md5(X.without_wiki_links(F.concat(F.lit("[["), "source", F.lit("]] "), "text"))).alias("plain"),
            X.cleaned_response(marked).alias("cleaned"),
            X.without_fences(F.concat(F.lit("```html\n"), F.left("text", F.lit(50)), F.lit("\n```"))).alias("unfenced"),
        )
    )


@query(r"""
WITH d AS (SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', 'X', 'g') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(regexp_replace(regexp_replace(t, '(?i)\b(thing)\b', '[[\1]]'), '(?i)\b(and)\b', '[[\1]]')) AS first, md5(regexp_replace(t, '(?i)\b(thing|and)\b', '[[\1]]', 'g')) AS every FROM d
""")
def linked_concepts(spark, sf_dir):
    """The first place of each concept as a link, and all places."""
    rows = _docs(spark, sf_dir).select("doc_id", F.regexp_replace("text", "[^\\x00-\\x7F]", "X").alias("t"))
    return rows.select("doc_id", F.md5(T.with_links(F.col("t"), ("and", "thing"))).alias("first"), F.md5(T.with_links(F.col("t"), ("and", "thing"), every=True)).alias("every"))


@query("""
SELECT doc_id, md5('---' || chr(10) || 'source: "' || source || '"' || chr(10) || CASE WHEN lang IS NULL THEN '' ELSE 'lang: "' || lang || '"' || chr(10) END || '---' || chr(10) || chr(10) || text) AS text FROM documents WHERE text IS NOT NULL
""")
def front_matter_rewrite(spark, sf_dir):
    rows = sinks.with_front_matter(_docs(spark, sf_dir).select("doc_id", "source", "lang", F.col("text").alias("body")), ("source", "lang"))
    return rows.select("doc_id", F.md5("text").alias("text"))


@query("SELECT count(*) AS originals, count(*) FILTER (doc_id % 5 <> 0) AS copies, count(*) FILTER (doc_id % 5 = 0) AS missing, count(*) FILTER (doc_id % 5 <> 0 AND doc_id % 7 = 0) AS different FROM documents WHERE text IS NOT NULL")
def copy_check(spark, sf_dir):
    """Copies of which a fifth is missing and others were changed."""
    docs = _docs(spark, sf_dir).select(F.col("doc_id").alias("path"), "text")
    return sinks.copied_right(docs, docs.where("path % 5 <> 0").withColumn("text", F.when(F.col("path") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))))


@query("SELECT date_trunc('hour', ts) - to_hours(i) AS start, count(*) AS n, round(sum(value), 2) AS total FROM events, (SELECT unnest(range(0, 5)) AS i) GROUP BY 1")
def sliding_usage(spark, sf_dir):
    """Windows of five hours, moved by an hour."""
    rows = streams.sliding_usage(table(spark, sf_dir, "events"), step="1 hour")
    return rows.select(F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 2).alias("total"))


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def daily_counters(spark, sf_dir):
    return streams.daily_counts(table(spark, sf_dir, "events")).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("""
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n, round(sum(value), 2) AS total FROM s GROUP BY user_id, s
""")
def user_sessions(spark, sf_dir):
    """Sessions that half an hour without an event ends."""
    rows = streams.sessions(table(spark, sf_dir, "events"))
    return rows.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 2).alias("total"))


_EXPERIMENTS = """
WITH c AS (SELECT conv_id AS id, turn AS place, role AS observation, CASE WHEN turn % 5 = 4 THEN 'archived' WHEN turn % 5 = 2 THEN 'running' END AS status FROM conversations),
e AS (SELECT id, coalesce(arg_max(status, place) FILTER (status IS NOT NULL), 'draft') AS status, string_agg(observation, ',' ORDER BY place, observation) AS observations, count(*) AS n FROM c GROUP BY id)
"""


def _experiments(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("at"), F.col("role").alias("observation"))
    status = F.when(F.col("at") % 5 == 4, "archived").when(F.col("at") % 5 == 2, "running")
    start = turns.select("id").distinct().select("id", F.lit("draft").alias("status"), F.lit("h").alias("hypothesis"), F.array().cast("array<string>").alias("observations"))
    return K.advanced(start, turns.withColumn("status", status))


@query(_EXPERIMENTS + "SELECT id, status, observations FROM e")
def experiments_advanced(spark, sf_dir):
    return _experiments(spark, sf_dir).select("id", "status", F.array_join("observations", ",").alias("observations"))


@query(_EXPERIMENTS + "SELECT id, n FROM e WHERE status = 'running'")
def experiment_watchlist(spark, sf_dir):
    return K.watchlist(_experiments(spark, sf_dir)).select("id", F.col("n").cast("long").alias("n"))


@query("""
SELECT doc_id, 'X' || doc_id AS name, 'Y' || (doc_id + 1) || ',Z' || (doc_id % 5) AS refers FROM documents UNION ALL SELECT doc_id, 'A1', 'B2,C3' FROM documents
""")
def reference_tables(spark, sf_dir):
    text = F.concat(F.lit("intro\nX"), "doc_id", F.lit(" -> [Y"), F.col("doc_id") + 1, F.lit(", Z"), F.col("doc_id") % 5, F.lit("]\n| A1 | B2, C3 |\nX"), "doc_id", F.lit(" -> [Q9]"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(K.cross_references(text)).alias("name", "v")).select("doc_id", "name", F.array_join("v", ",").alias("refers"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'live' WHEN doc_id % 3 = 1 THEN 'interview' ELSE 'other' END AS kind, source AS artist, CAST(1990 + doc_id % 40 AS INTEGER) AS year FROM documents")
def title_kinds(spark, sf_dir):
    word = F.element_at(F.array(F.lit("Live in"), F.lit("An interview"), F.lit("Album")), (F.col("doc_id") % 3 + 1).cast("int"))
    title = F.concat("source", F.lit(" - "), word, F.lit(" ("), 1990 + F.col("doc_id") % 40, F.lit(")"))
    kind, artist, year = K.title_kind(title, (("live", "(?i)\\blive\\b"), ("interview", "(?i)interview")))
    return table(spark, sf_dir, "documents").select("doc_id", kind.alias("kind"), artist.alias("artist"), year.alias("year"))


@query("SELECT CAST(user_id AS VARCHAR) AS rule, count(*) AS idle_days FROM events WHERE user_id % 7 <> 0 AND user_id <> 3 GROUP BY user_id HAVING count(*) >= 60")
def inactive_rules(spark, sf_dir):
    """Users as rules, idle for as many days as they have events; each seventh sleeps already."""
    state = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("idle_days")).select(F.col("user_id").cast("string").alias("rule"), "idle_days", (F.col("user_id") % 7 == 0).alias("dormant"))
    return R.candidates_for_sleep(state, pinned=["3"])
