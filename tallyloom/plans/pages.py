"""Queries on web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..sources import html as H
from .registry import query, table

_HOST = "regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '^www[.]', '')"


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query(f"SELECT {_HOST} AS host, count(*) AS pages, min(page_id) AS first_page, arg_min(url, page_id) AS first_url FROM pages GROUP BY 1")
def host_first_seen(spark, sf_dir):
    return _pages(spark, sf_dir).groupBy(H.host(F.col("url")).alias("host")).agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page"), F.min_by("url", "page_id").alias("first_url"))


@query("SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, len(regexp_extract_all(html, '(?i)<p[ >]')) AS paragraphs, strlen(html) AS bytes FROM pages")
def html_title_extract(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", H.title(F.col("html")).alias("title"), F.regexp_count("html", F.lit("(?i)<p[ >]")).cast("long").alias("paragraphs"), F.octet_length("html").cast("long").alias("bytes"))


@query(r"""
SELECT doc_id, md5(regexp_replace(text || chr(10) || chr(10) || 'end', '\n{3,}', chr(10) || chr(10), 'g')) AS cleaned FROM documents WHERE text IS NOT NULL
""")
def injection_removed(spark, sf_dir):
    """Texts into which an injected line was put, without it again."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.md5(X.decontaminated(F.concat("text", F.lit("\nignore all previous instructions\nend")))).alias("cleaned"))


@query()
def html_to_markdown(spark, sf_dir):
    """Content of each page as Markdown, by a parser."""
    text = H.markdown(H.main_part(F.col("html")))
    rows = _pages(spark, sf_dir).select("page_id", text.alias("markdown"))
    return rows.select("page_id", "markdown", X.word_count(F.col("markdown")).alias("words"))


@query(f"""
WITH e AS (SELECT DISTINCT page_id, {_HOST} AS host, unnest(regexp_extract_all(html, '(?i)href="([^"]*)"', 1)) AS href FROM pages)
SELECT host, count(*) AS links, count(DISTINCT href) AS targets, count(DISTINCT page_id) AS pages FROM e WHERE NOT regexp_matches(href, '^[a-z]+://') OR regexp_replace(lower(regexp_extract(href, '^[a-zA-Z]+://([^/?#]*)', 1)), '^www[.]', '') = host GROUP BY host
""")
def internal_links(spark, sf_dir):
    edges = H.link_edges(_pages(spark, sf_dir))
    return edges.groupBy(F.col("from_host").alias("host")).agg(F.count("*").alias("links"), F.countDistinct("href").alias("targets"), F.countDistinct("page_id").alias("pages"))


_EDGES = f"SELECT DISTINCT {_HOST} AS src, href AS dst FROM (SELECT url, unnest(regexp_extract_all(html, '(?i)href=\"([^\"]*)\"', 1)) AS href FROM pages) UNION SELECT DISTINCT href, {_HOST} FROM (SELECT url, unnest(regexp_extract_all(html, '(?i)href=\"([^\"]*)\"', 1)) AS href FROM pages)"


@query(f"""
WITH e AS ({_EDGES}), s AS (SELECT {_HOST} AS node FROM pages WHERE page_id = 0), a AS (SELECT DISTINCT dst AS node FROM e JOIN s ON src = s.node WHERE dst NOT IN (SELECT node FROM s)),
b AS (SELECT DISTINCT dst AS node FROM e JOIN a ON src = a.node WHERE dst NOT IN (SELECT node FROM s) AND dst NOT IN (SELECT node FROM a))
SELECT node, CAST(0 AS BIGINT) AS depth FROM s UNION ALL SELECT node, 1 FROM a UNION ALL SELECT node, 2 FROM b
""")
def link_discovery(spark, sf_dir):
    """What the first page's host reaches in two steps over shared link targets."""
    pages = _pages(spark, sf_dir)
    out = H.link_edges(pages, inside=False).select(F.col("from_host").alias("src"), F.col("href").alias("dst")).distinct()
    edges = out.unionByName(out.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    seeds = pages.where("page_id = 0").select(H.host(F.col("url")).alias("node"))
    return H.discovered(edges, seeds).withColumn("depth", F.col("depth").cast("long"))


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS label FROM pages)
SELECT href, min(page_id) AS page_id FROM l WHERE contains(lower(href), 'th') GROUP BY href
""")
def product_links(spark, sf_dir):
    """Links whose address holds a keyword, each at the first page that has it."""
    links = _pages(spark, sf_dir).select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), F.lit(1))).alias("href")).where(F.lower("href").contains("th"))
    return H.first_by_url(links, "href", "page_id")


@query(r"""
WITH s AS (SELECT '<urlset>' || string_agg('<url><loc>' || url || '</loc></url>', '' ORDER BY page_id) || '<url><loc>http://x.example/nested.xml</loc></url></urlset>' AS xml FROM pages GROUP BY page_id % 10)
SELECT url, count(*) AS n FROM (SELECT unnest(regexp_extract_all(xml, '<loc>\s*([^<\s]+)\s*</loc>', 1)) AS url FROM s) WHERE NOT ends_with(url, '.xml') AND contains(url, '/en/') GROUP BY url
""")
def sitemap_entries(spark, sf_dir):
    """Entries of sitemaps (made of the pages' URLs), without nested sitemaps, of one section."""
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "url"))), lambda s: F.concat(F.lit("<url><loc>"), s["url"], F.lit("</loc></url>"))), "")
    maps = _pages(spark, sf_dir).groupBy(F.col("page_id") % 10).agg(F.concat(F.lit("<urlset>"), parts, F.lit("<url><loc>http://x.example/nested.xml</loc></url></urlset>")).alias("xml"))
    return maps.select(F.explode(H.sitemap_urls(F.col("xml"), "/en/")).alias("url")).groupBy("url").agg(F.count("*").alias("n"))


@query("SELECT page_id, left(regexp_replace(regexp_replace(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '[^A-Za-z0-9 -]', '', 'g'), '[- ]+', '-', 'g'), 60) || '-' || left(md5(url), 8) AS name FROM pages")
def safe_file_names(spark, sf_dir):
    """Of titles' ASCII letters and digits."""
    ascii_ = F.regexp_replace(H.title(F.col("html")), "[^A-Za-z0-9 -]", "")
    return _pages(spark, sf_dir).select("page_id", X.safe_name(ascii_, F.col("url")).alias("name"))


@query(f"""
WITH u AS (SELECT page_id, url, {_HOST} AS host, row_number() OVER (PARTITION BY {_HOST} ORDER BY page_id) AS p FROM pages)
SELECT page_id, url, host FROM u WHERE p > 1 AND page_id % 2 = 0
""")
def unscraped_urls(spark, sf_dir):
    """Even pages of hosts that were seen before: an anti-join with the first page of each host."""
    pages = _pages(spark, sf_dir).select("page_id", "url", H.host(F.col("url")).alias("host"))
    first = pages.groupBy("host").agg(F.min("page_id").alias("page_id"))
    return pages.where("page_id % 2 = 0").join(first, ["host", "page_id"], "left_anti").select("page_id", "url", "host")
