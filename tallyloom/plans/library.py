"""Queries on whole texts: articles and their index, skills, sessions' files, excerpts, cleaned texts, links, references, titles; and small columns on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..operators import checks as K
from ..operators import rules as R
from ..operators import texts as T
from ..sources import html as H
from ..sources import library as L
from ..sources import logs
from ..sources import shared
from ..sources import subtitles as S
from .registry import query, table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _articles(spark, sf_dir):
    title = F.regexp_replace(F.split("text", "\n")[0], "[^ -~]", "")
    date = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("2024-0"), F.col("doc_id") % 9 + 1, F.lit("-11")))
    url = F.concat(F.lit("https://example.org/"), "doc_id")
    return _docs(spark, sf_dir).where("source IS NOT NULL").select(F.col("doc_id").alias("id"), title.alias("title"), F.col("lang").alias("author"), date.alias("date"), url.alias("url"), "source", F.col("text").alias("body"))


_ARTICLES = r"""
WITH a AS (SELECT doc_id AS id, source, lang AS author, CASE WHEN doc_id % 3 <> 0 THEN '2024-0' || (doc_id % 9 + 1) || '-11' END AS date, 'https://example.org/' || doc_id AS url, coalesce(text, '') AS body,
  coalesce(nullif(trim(regexp_replace(string_split(text, chr(10))[1], '[^ -~]', '', 'g')), ''), 'Untitled') AS title FROM documents WHERE source IS NOT NULL)
"""
_WORDS = r"len(regexp_extract_all(body, '[^\s\x0B\x1C-\x1F\x85\p{Z}]+'))"


@query(_ARTICLES + rf"""
SELECT source, lpad(id::VARCHAR, greatest(3, length(id::VARCHAR))::INTEGER, '0') || '-' || left(regexp_replace(regexp_replace(lower(title), '[^\w\s-]', '', 'g'), '[-\s]+', '-', 'g'), 50) || '.md' AS name, {_WORDS}::BIGINT AS words,
  md5('# ' || title || chr(10) || chr(10) || '**Author:** ' || coalesce(author, 'Unknown') || chr(10) || '**Date:** ' || coalesce(date, 'Unknown') || chr(10) || '**URL:** ' || url || chr(10) || chr(10) || '---' || chr(10) || chr(10) || body || chr(10)) AS text FROM a
""")
def article_files(spark, sf_dir):
    """Documents as article files with a header."""
    return L.article_files(_articles(spark, sf_dir)).select("source", "name", "words", F.md5("text").alias("text"))


@query(_ARTICLES + "SELECT source, row_number() OVER (PARTITION BY source ORDER BY id) AS place, '- [' || title || '](' || url || ')' AS line FROM a")
def article_index(spark, sf_dir):
    """Each source's index, saved and read again."""
    path = shared.new_path(spark)
    L.save(_articles(spark, sf_dir), path)
    return spark.read.schema("source string, place long, line string").json(f"{path}/index")


@query(_ARTICLES + f"SELECT source, count(*) AS articles, count(*) FILTER (trim(body) = '') AS empty, sum({_WORDS})::BIGINT AS words, min(date) AS first, max(date) AS last FROM a GROUP BY source")
def article_metadata(spark, sf_dir):
    return L.metadata(_articles(spark, sf_dir))


@query(r"""
WITH s AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '---' || chr(10) || 'description: "About ' || doc_id || '"' || chr(10) || 'category: c' || (doc_id % 4) || chr(10) || '---' || chr(10) ELSE '# S' || chr(10) END || text || CASE WHEN doc_id % 3 = 1 THEN chr(10) || 'Use when ' || text || chr(10) || '# End' ELSE '' END AS t FROM documents WHERE text IS NOT NULL)
SELECT 's' || doc_id AS name, md5(CASE WHEN doc_id % 3 = 0 THEN 'About ' || doc_id ELSE replace(trim(regexp_extract(t, '(?s)(Use (?:when|this).+?)(?:\n\n|\n#|\z)', 1)), chr(10), ' ') END) AS description, CASE WHEN doc_id % 3 = 0 THEN 'c' || (doc_id % 4) ELSE '' END AS category FROM s
""")
def skill_descriptions(spark, sf_dir):
    """Texts as skills: a third with front matter, a third with a paragraph that says when to use them, the others with neither."""
    k = F.col("doc_id") % 3
    front = F.concat(F.lit('---\ndescription: "About '), "doc_id", F.lit('"\ncategory: c'), F.col("doc_id") % 4, F.lit("\n---\n"))
    text = F.concat(F.when(k == 0, front).otherwise("# S\n"), "text", F.when(k == 1, F.concat(F.lit("\nUse when "), "text", F.lit("\n# End"))).otherwise(""))
    rows = L.skills(_docs(spark, sf_dir).where("text IS NOT NULL").select(F.concat(F.lit("/k/s"), "doc_id", F.lit("/SKILL.md")).alias("path"), text.alias("text")))
    return rows.select("name", F.md5("description").alias("description"), "category")


@query("""
WITH b AS (SELECT conv_id, turn, ['Write', 'Edit', 'Read', 'MultiEdit'][turn % 4 + 1] AS tool, '/f/' || (turn % 3) AS target FROM conversations WHERE text IS NOT NULL),
f AS (SELECT conv_id, target, bool_or(tool = 'Write') AS written FROM b WHERE tool <> 'Read' GROUP BY ALL), g AS (SELECT conv_id, array_to_string(list_sort(list(target) FILTER (written)), ',') AS created, array_to_string(list_sort(list(target) FILTER (NOT written)), ',') AS edited FROM f GROUP BY conv_id)
SELECT conv_id, count(*) AS calls, count(DISTINCT tool) AS tools, count(*) FILTER (turn % 2 = 1) AS errors, coalesce(any_value(created), '') AS created, coalesce(any_value(edited), '') AS edited FROM b LEFT JOIN g USING (conv_id) GROUP BY conv_id
""")
def session_files(spark, sf_dir):
    """Conversations as session records in JSON: what their tools wrote, edited and failed at."""
    turns = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    tool = F.element_at(F.array(*map(F.lit, ("Write", "Edit", "Read", "MultiEdit"))), (F.col("turn") % 4 + 1).cast("int"))
    blocks = F.array(
        F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("map<string,string>").alias("input"), F.lit(None).cast("boolean").alias("is_error")),
        F.struct(F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), tool.alias("name"), F.create_map(F.lit("file_path"), F.concat(F.lit("/f/"), F.col("turn") % 3)).alias("input"), F.lit(None).cast("boolean").alias("is_error")),
        F.struct(F.lit("tool_result").alias("type"), F.lit("x").alias("text"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("map<string,string>").alias("input"), (F.col("turn") % 2 == 1).alias("is_error")),
    )
    records = turns.select(F.col("conv_id").alias("path"), F.col("turn").alias("line"), F.struct("role", F.to_json(blocks).alias("content")).alias("message"))
    rows = L.session_files(logs.blocks(records))
    return rows.select(F.col("path").alias("conv_id"), "calls", "tools", "errors", F.array_join("created", ",").alias("created"), F.array_join("edited", ",").alias("edited"))


@query("""
WITH a AS (SELECT lower(substr(source, 1, 3)) || (doc_id % 10) AS alias, min(source) AS canonical FROM documents WHERE source IS NOT NULL GROUP BY ALL), k AS (SELECT alias, min(canonical) AS canonical FROM (SELECT alias, canonical FROM a UNION ALL SELECT lower(canonical), canonical FROM a) GROUP BY alias),
q AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN ' SRC' || (doc_id % 10) || ' ' WHEN 1 THEN upper(source) ELSE 'nobody' END AS name FROM documents)
SELECT doc_id, name, canonical FROM q LEFT JOIN k ON k.alias = lower(trim(name))
""")
def canonical_names(spark, sf_dir):
    """Aliases, names in other cases and unknown names."""
    docs = _docs(spark, sf_dir)
    aliases = docs.where("source IS NOT NULL").groupBy(F.concat(F.lower(F.substring("source", 1, 3)), F.col("doc_id") % 10).alias("alias")).agg(F.min("source").alias("canonical"))
    name = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" SRC"), F.col("doc_id") % 10, F.lit(" "))).when(F.col("doc_id") % 3 == 1, F.upper("source")).otherwise("nobody")
    return L.canonical(docs.select("doc_id", name.alias("name")), aliases, "name").select("doc_id", "name", "canonical")


@query(r"""
WITH q AS (SELECT DISTINCT item_id, unnest(string_split_regex(trim(lower(text)), '\s+')) AS word FROM benchmark), s AS (SELECT * FROM (VALUES ('the', 'other thing'), ('and', 'the'), ('que', 'and')) AS t(word, synonym)),
l AS (SELECT item_id, word, 1.0 AS w FROM q UNION ALL SELECT item_id, regexp_replace(word, '(ing|ed|s)$', ''), 0.7 FROM q WHERE regexp_replace(word, '(ing|ed|s)$', '') NOT IN ('', word) UNION ALL SELECT item_id, unnest(string_split(synonym, ' ')), 0.5 FROM q JOIN s USING (word))
SELECT item_id, word, max(w)::DOUBLE AS weight FROM l WHERE word <> '' GROUP BY ALL
""")
def expanded_queries(spark, sf_dir):
    """Every item's words, their stems (three endings less) and synonyms, with weights."""
    synonyms = spark.createDataFrame([("the", "other thing"), ("and", "the"), ("que", "and")], "word string, synonym string")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return L.expanded(items, synonyms, lambda w: F.regexp_replace(w, "(ing|ed|s)$", "")).withColumnRenamed("id", "item_id")


_MARKED = "list_transform(string_split(text, chr(10)), lambda x, i: CASE (i - 1) % 4 WHEN 0 THEN '# ' || x WHEN 1 THEN '- ' || x WHEN 2 THEN '**' || x || '**' ELSE '![p](q)' || x || '[a](b)' END)"


def _marked():
    """The lines of a text as headings, bullets, bold lines, and lines with an image and a link, in turn."""
    of = lambda x, i: F.when(i % 4 == 0, F.concat(F.lit("# "), x)).when(i % 4 == 1, F.concat(F.lit("- "), x)).when(i % 4 == 2, F.concat(F.lit("**"), x, F.lit("**"))).otherwise(F.concat(F.lit("![p](q)"), x, F.lit("[a](b)")))
    return F.array_join(F.transform(F.split("text", "\n"), of), "\n")


@query(rf"""
WITH d AS (SELECT doc_id, array_to_string({_MARKED}, chr(10)) AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(array_to_string(string_split(regexp_replace(regexp_replace(regexp_replace(t, '!\[.*?\]\(.*?\)', '', 'g'), '\[(.*?)\]\(.*?\)', '\1', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), chr(10))[1:8], chr(10))) AS excerpt FROM d
""")
def excerpts(spark, sf_dir):
    """The first eight lines of whole texts with images and links."""
    return _docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", F.md5(X.excerpt(_marked())).alias("excerpt"))


@query(rf"""
WITH d AS (SELECT doc_id, regexp_replace(text, '[*_]', '', 'g') AS text FROM documents WHERE text IS NOT NULL), m AS (SELECT doc_id, array_to_string({_MARKED}, chr(10)) AS t FROM d)
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?m)^#{{1,6}}\s+', '', 'g'), '\*\*(.+?)\*\*', '\1', 'g'), '(?m)^[-*_]{{3,}}\s*$', '', 'g'), '(?m)^\s*[-*]\s+', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'))) AS cleaned FROM m
""")
def cleaned_answers(spark, sf_dir):
    """Whole texts with marks of Markdown, cleaned."""
    rows = _docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", F.regexp_replace("text", "[*_]", "").alias("text"))
    return rows.select("doc_id", F.md5(X.cleaned_response(_marked())).alias("cleaned"))


@query("SELECT doc_id, md5(trim(text)) AS unfenced FROM documents WHERE text IS NOT NULL AND NOT contains(text, '`')")
def unfenced_texts(spark, sf_dir):
    """Whole texts in a fence, and out of it again."""
    rows = _docs(spark, sf_dir).where("text IS NOT NULL AND NOT contains(text, '`')")
    return rows.select("doc_id", F.md5(X.without_fences(F.concat(F.lit("```html\n"), "text", F.lit("\n```\n")))).alias("unfenced"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(coalesce(text, ''), '[0-9]', '', 'g'), '[^\n]*[A-Z][A-Z]+!![^\n]*')) AS x FROM documents)
SELECT doc_id, 'K' || doc_id AS name, count(*) AS n FROM l GROUP BY doc_id
""")
def shouted_references(spark, sf_dir):
    """Lines with shouted words, as rows of a reference table that names each line."""
    lines = F.filter(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "[0-9]", ""), "\n"), lambda x: x.rlike("[A-Z][A-Z]+!!"))
    text = F.concat(F.lit("| K"), "doc_id", F.lit(" | "), F.array_join(F.transform(lines, lambda x, i: F.concat(x, F.lit(" Z"), i)), " "), F.lit(" |"))
    rows = _docs(spark, sf_dir).where(F.size(lines) > 0).select("doc_id", F.explode(K.cross_references(text)).alias("name", "refers"))
    return rows.select("doc_id", "name", F.size("refers").cast("long").alias("n"))


@query(r"""
WITH d AS (SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', 'X', 'g') AS t FROM documents WHERE text IS NOT NULL AND NOT contains(text, '[') AND NOT contains(text, ']')), b AS (SELECT doc_id, regexp_replace(t, '\b(of)\b', '[[\1]]', 'g') AS t FROM d)
SELECT doc_id, md5(CASE WHEN regexp_matches(t, '(?is)^.*?\b(and)\b') AND (regexp_matches(left(t, length(regexp_extract(t, '(?is)^(.*?)\band\b', 1))), '\[\[.?$') OR regexp_matches(substr(t, length(regexp_extract(t, '(?is)^(.*?)\band\b', 1)) + 4, 3), '^.?\]\]')) THEN t ELSE regexp_replace(t, '(?i)\b(and)\b', '[[\1]]') END) AS linked FROM b
""")
def links_beside_brackets(spark, sf_dir):
    """The first place of a concept, in texts where another one is linked everywhere: brackets within three characters keep it as it is."""
    rows = _docs(spark, sf_dir).where("text IS NOT NULL AND NOT contains(text, '[') AND NOT contains(text, ']')")
    text = F.regexp_replace(F.regexp_replace("text", "[^\\x00-\\x7F]", "X"), r"\b(of)\b", "[[$1]]")
    return rows.select("doc_id", F.md5(T.with_links(text, ("and",))).alias("linked"))


@query(r"""
WITH d AS (SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t FROM pages)
SELECT page_id, CASE WHEN regexp_matches(t, '(?i)\bthe\b') THEN 'the' WHEN regexp_matches(t, '(?i)que') THEN 'que' ELSE 'other' END AS kind, nullif(trim(regexp_extract(t, '^(.+?)\s+[-–—]\s+', 1)), '') AS artist, TRY_CAST(nullif(regexp_extract(t, '(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)', 1), '') AS INTEGER) AS year FROM d
""")
def page_title_kinds(spark, sf_dir):
    """The pages' own titles."""
    title = F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)
    kind, artist, year = K.title_kind(title, (("the", "(?i)\\bthe\\b"), ("que", "(?i)que")))
    return table(spark, sf_dir, "pages").select("page_id", kind.alias("kind"), artist.alias("artist"), year.alias("year"))


@query("""
WITH t AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS topic FROM documents WHERE text IS NOT NULL), s AS (SELECT topic, contains(lower(topic), 'the')::BIGINT + contains(lower(topic), 'and')::BIGINT + contains(lower(topic), 'ing')::BIGINT AS score FROM t)
SELECT score, count(*) AS topics, min(md5(topic)) AS first FROM s WHERE score > 0 GROUP BY score
""")
def topic_scores(spark, sf_dir):
    """All lines as topics, whole, by how many of the terms they hold."""
    from ..operators import extraction as E

    lines = _docs(spark, sf_dir).where("text IS NOT NULL").select(F.explode(F.split("text", "\n")).alias("topic")).distinct()
    scored = E.topics(lines, ("the", "and", "ing"), top=None)
    return scored.groupBy("score").agg(F.count("*").alias("topics"), F.min(F.md5("topic")).alias("first"))


_HOST = "regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '^www[.]', '')"


@query(f"WITH h AS (SELECT {_HOST} AS host, max(page_id) % 4 = 0 AS down, count(*) AS pages FROM pages GROUP BY 1) SELECT CASE WHEN down THEN 'DOWN' ELSE 'UP' END AS status, count(*) AS hosts, sum(pages)::BIGINT AS pages FROM h GROUP BY 1")
def heartbeat_counts(spark, sf_dir):
    """All hosts, up or down by their last page."""
    hosts = table(spark, sf_dir, "pages").groupBy(H.host(F.col("url")).alias("host")).agg(F.max("page_id").alias("last"), F.count("*").alias("pages"))
    return hosts.groupBy(F.when(F.col("last") % 4 == 0, "DOWN").otherwise("UP").alias("status")).agg(F.count("*").alias("hosts"), F.sum("pages").alias("pages"))


@query("""
SELECT event_id, CASE WHEN event_id % 4 < 2 THEN strftime(ts, '%Y-%m-%d') END AS day, CASE WHEN v < 60 THEN printf('%.1fs', v) ELSE (v::BIGINT // 60) || 'm ' || (v::BIGINT % 60) || 's' END AS short, CASE WHEN v < 1 THEN '0.0s' WHEN v < 60 THEN v::BIGINT || 'm 0s' ELSE (v::BIGINT // 60) || 'h ' || (v::BIGINT % 60) || 'm' END AS long FROM (SELECT *, floor(value) AS v FROM events)
""")
def dates_and_durations(spark, sf_dir):
    """Dates from whole time stamps and from days; none from broken or empty ones. Durations of seconds, and of as many minutes."""
    k = F.col("event_id") % 4
    text = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).when(k == 2, F.date_format("ts", "yyyy-MM")).otherwise("")
    whole = F.floor("value")
    return table(spark, sf_dir, "events").select("event_id", D.safe_date(text).cast("string").alias("day"), D.duration_label(whole).alias("short"), D.duration_label(whole * 60).alias("long"))


@query("""
WITH r AS (SELECT DISTINCT ts::DATE AS day, user_id % 3 AS team, 'r' || lpad((user_id % 60)::VARCHAR, 2, '0') AS rule FROM events), p AS (SELECT a.rule AS a, b.rule AS b, count(*) AS together FROM r a JOIN r b ON a.day = b.day AND a.team = b.team AND a.rule < b.rule GROUP BY ALL),
n AS (SELECT rule, count(*) AS n FROM r GROUP BY rule), c AS (SELECT a, b, together, x.n + y.n - together AS either FROM p JOIN n x ON x.rule = a JOIN n y ON y.rule = b), t AS (SELECT count(*) > 500 AS many FROM c)
SELECT a, b, together, either FROM c, t WHERE NOT many OR either >= 5 QUALIFY NOT many OR row_number() OVER (ORDER BY either DESC, a, b) <= 500
""")
def pruned_pairs(spark, sf_dir):
    """Pairs of rules of the same team and day; beyond five hundred only the most frequent."""
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), (F.col("user_id") % 3).alias("team"), F.concat(F.lit("r"), F.lpad((F.col("user_id") % 60).cast("string"), 2, "0")).alias("rule"))
    return R.kept_pairs(R.co_activations(rows, ["day", "team"], "rule")).select("a", "b", "together", "either")


@query("""
WITH r AS (SELECT 'p' || p_partkey AS id, p_size, p_partkey FROM part)
SELECT id, 'unknown domain' AS problem FROM r WHERE p_size % 7 = 0 UNION ALL SELECT id, 'consequence out of range' FROM r WHERE NOT (p_size / 100.0 BETWEEN 0.1 AND 0.3) UNION ALL SELECT id, 'no domain' FROM r WHERE p_size % 11 = 0 AND p_size % 7 <> 0
UNION ALL SELECT id, 'unknown link p' || (p_partkey + 100) FROM r WHERE 'p' || (p_partkey + 100) NOT IN (SELECT id FROM r)
""")
def rule_problems(spark, sf_dir):
    """Parts as rules: some of unknown domains, with consequences out of range, or linked to none."""
    size = F.col("p_size")
    domains = F.when(size % 7 == 0, F.array(F.lit("music"), F.lit("nowhere"))).when(size % 11 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("all")))
    links = F.create_map(F.concat(F.lit("p"), F.col("p_partkey") + 100), F.lit(0.5))
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), domains.alias("domains"), (size / 100.0).alias("consequence"), links.alias("links"))
    return R.problems(rows, ("music", "code"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL), t AS (SELECT doc_id, i, trim(regexp_replace(x, '<[^>]+>', '', 'g')) AS line FROM l),
o AS (SELECT doc_id, line, min(i) AS i FROM t WHERE line <> '' AND NOT regexp_matches(line, '^(WEBVTT|NOTE|STYLE|Kind:|Language:)') AND NOT regexp_matches(line, '^[0-9]+$') AND NOT contains(line, '-->') AND NOT regexp_matches(line, '^\[[^\]]*\]$') GROUP BY ALL)
SELECT doc_id, count(*) AS lines, md5(string_agg(line, ' ' ORDER BY i)) AS spoken FROM o GROUP BY doc_id
""")
def caption_texts(spark, sf_dir):
    """Texts as numbered captions of the older format, with commas in their times; what is spoken, joined."""
    time = lambda i: F.concat(F.lit("00:00:"), F.lpad(i.cast("string"), 2, "0"), F.lit(",000"))
    cues = F.transform(F.split("text", "\n"), lambda x, i: F.concat((i + 1).cast("string"), F.lit("\r\n"), time(i), F.lit(" --> "), time(i + 1), F.lit("\r\n"), x, F.lit("\r\n")))
    rows = S.spoken(_docs(spark, sf_dir).select(F.col("doc_id").alias("path"), F.array_join(cues, "\r\n").alias("text")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), " ")
    return rows.groupBy(F.col("path").alias("doc_id")).agg(F.count("*").alias("lines"), F.md5(joined).alias("spoken"))


@query("SELECT page_id, md5(html) AS html FROM pages WHERE html IS NOT NULL")
def embedded_pages(spark, sf_dir):
    """Pages as JSON strings that scripts push, in two pieces, and out of them again."""
    piece = lambda x: F.concat(F.lit("self.push([1,"), F.regexp_replace(F.to_json(F.struct(x.alias("x"))), r'(?s)^\{"x":(.*)\}$', "$1"), F.lit("])"))
    half = F.floor(F.length("html") / 2).cast("int")
    script = F.concat(F.lit("<script>"), piece(F.left("html", half)), F.lit("</script><script>"), piece(F.substr("html", half + 1, F.length("html"))), F.lit("</script>"))
    return table(spark, sf_dir, "pages").where("html IS NOT NULL").select("page_id", F.md5(H.embedded_html(script)).alias("html"))


@query("SELECT 'Page ' || page_id AS title, url AS link, 'day ' || (page_id % 28) AS published, count(*) AS n FROM pages WHERE url IS NOT NULL GROUP BY ALL")
def feed_items(spark, sf_dir):
    """Pages as the items of feeds, in XML files that Spark wrote, read again."""
    escaped = F.regexp_replace(F.regexp_replace("url", "&", "&amp;"), "<", "&lt;")
    item = F.concat(F.lit("<item><title>Page "), "page_id", F.lit("</title><link>"), escaped, F.lit("</link><pubDate>day "), F.col("page_id") % 28, F.lit("</pubDate></item>"))
    path = shared.new_path(spark)
    feeds = table(spark, sf_dir, "pages").where("url IS NOT NULL").groupBy(F.floor(F.col("page_id") / 100).alias("feed")).agg(F.array_join(F.collect_list(item), "").alias("items"))
    whole = F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>"))
    feeds.select("feed", whole.alias("value")).repartition("feed").write.partitionBy("feed").text(path)  # a hundred items a file
    return H.feed(spark, path).groupBy("title", "link", "published").agg(F.count("*").alias("n"))
