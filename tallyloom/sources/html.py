"""Web pages: titles, text, links, sitemaps and feeds, read from columns or files; nothing is fetched."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def host(url: Column) -> Column:
    """The host in lower case, without `www.`."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[a-zA-Z]+://([^/?#]*)", 1)), "^www\\.", "")


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('(?i)href="([^"]*)"'), F.lit(1))


class _Text(HTMLParser):
    """Markdown of a page's content: headings, paragraphs, lists, links; the frame of the page is left out."""

    SKIPPED = {"script", "style", "nav", "header", "footer", "aside", "noscript", "template"}
    BREAKS = {"p", "div", "article", "section", "br", "ul", "ol", "table", "tr", "blockquote"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skipped, self.link = [], [], None

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIPPED:
            self.skipped.append(tag)
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag in self.BREAKS:
            self.out.append("\n\n")
        elif tag == "a":
            self.link = dict(attrs).get("href")
            self.out.append("[" if self.link else "")

    def handle_endtag(self, tag):
        if self.skipped and tag == self.skipped[-1]:
            self.skipped.pop()
        elif tag == "a" and self.link:
            self.out.append(f"]({self.link})")
            self.link = None
        elif tag in self.BREAKS or re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.skipped:
            self.out.append(re.sub(r"\s+", " ", data))


def to_markdown(html: str) -> str:
    parser = _Text()
    parser.feed(html)
    parser.close()
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", "".join(x for x in parser.out if x))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


@F.pandas_udf(T.StringType())
def markdown(html: pd.Series) -> pd.Series:
    return html.map(to_markdown, na_action="ignore")


def main_part(html: Column) -> Column:
    """What the first of article, main or body holds; else all."""
    part = lambda tag: F.nullif(F.regexp_extract(html, f"(?is)<{tag}\\b[^>]*>(.*)</{tag}>", 1), F.lit(""))
    return F.coalesce(part("article"), part("main"), part("body"), html)


def embedded(html: str) -> str:
    """HTML that scripts push as JSON strings, joined."""
    parts = re.findall(r'\.push\(\[1,("(?:[^"\\]|\\.)*")\]\)', html)
    found = []
    for p in parts:
        try:
            found.append(json.loads(p))
        except ValueError:
            continue
    return "".join(found)


@F.pandas_udf(T.StringType())
def embedded_html(html: pd.Series) -> pd.Series:
    return html.map(embedded, na_action="ignore")


def sitemap_urls(xml: Column, containing: str = "") -> Column:
    """The `<loc>` entries that aren't sitemaps themselves."""
    found = F.regexp_extract_all(xml, F.lit("<loc>\\s*([^<\\s]+)\\s*</loc>"), F.lit(1))
    return F.filter(found, lambda u: ~u.endswith(".xml") & u.contains(containing))


def feed(spark: SparkSession, path: str) -> DataFrame:
    """title, link, published, description of a feed's items, in files."""
    rows = spark.read.format("xml").option("rowTag", "item").schema("title string, link string, pubDate string, description string").load(path)
    return rows.withColumnRenamed("pubDate", "published")


def link_edges(pages: DataFrame, inside: bool = True) -> DataFrame:
    """page_id, from_host, path: the links of each page; relative ones stay on the host."""
    rows = pages.select("page_id", host(F.col("url")).alias("from_host"), F.explode(F.array_distinct(hrefs(F.col("html")))).alias("href"))
    to = F.when(F.col("href").rlike("^[a-z]+://"), host(F.col("href"))).otherwise(F.col("from_host"))
    rows = rows.withColumn("to_host", to)
    return rows.where("to_host = from_host") if inside else rows


def discovered(edges: DataFrame, seeds: DataFrame, depth: int = 2) -> DataFrame:
    """node, depth: what links reach from the seeds within so many steps. edges: src, dst; seeds: node.

    Each step joins the last step's new nodes with the edges; the number of steps is a small argument.
    """
    found = seeds.select("node").distinct().withColumn("depth", F.lit(0))
    last = found
    for d in range(1, depth + 1):
        new = last.join(edges, last["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct()
        last = new.join(found.select("node"), "node", "left_anti").withColumn("depth", F.lit(d))
        found = found.unionByName(last)
    return found


def first_by_url(links: DataFrame, url: str, order: str) -> DataFrame:
    """The first row of each URL."""
    rest = [c for c in links.columns if c != url]
    return links.groupBy(url).agg(F.min_by(F.struct(*rest), order).alias("r")).select(url, "r.*")
