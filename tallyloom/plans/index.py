"""Queries on an inverted index, and joins by containment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import containment as N
from ..operators import fulltext as T
from ..sources import shared
from .registry import dealt, query, table


def _index(spark, sf_dir):
    return T.Index(spark, shared.new_path(spark)).add(dealt(spark, sf_dir, "documents", "doc_id", "text"))


_WORDS = r"regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '[\p{L}\p{N}]+')"
_TERMS = f"WITH w AS (SELECT doc_id, source, {_WORDS} AS w FROM documents), d AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS t FROM w)"


@query(f"""
{_TERMS} SELECT doc_id FROM d WHERE (contains(t, ' the ') AND (contains(t, ' and the ') OR contains(t, ' ther'))) OR (contains(t, ' que ') AND NOT contains(t, ' de la '))
""")
def fulltext_match(spark, sf_dir):
    """A word with a phrase or a prefix, or another word without a phrase; from postings alone."""
    asked = T.either(T.both(T.word("the"), T.either(T.phrase("and the"), T.prefix("ther"))), T.without(T.word("que"), T.phrase("de la")))
    return _index(spark, sf_dir).match(asked).select(F.col("doc").alias("doc_id"))


@query(f"""
{_TERMS} SELECT doc_id FROM d WHERE regexp_matches(t, ' die ([^ ]+ ){{0,3}}ein ') OR regexp_matches(t, ' ein ([^ ]+ ){{0,3}}die ')
""")
def fulltext_near(spark, sf_dir):
    """Two words with at most three others between them, in either order."""
    return _index(spark, sf_dir).match(T.near("die", "ein", 3)).select(F.col("doc").alias("doc_id"))


@query(rf"""
{_TERMS}, c AS (SELECT doc_id, source, len(w) AS len, len(list_filter(w, lambda x: x = 'erst')) AS a, len(list_filter(list_zip(w, w[2:]), lambda p: p[1] = 'of' AND p[2] = 'the')) AS b FROM d),
s AS (SELECT count(*) AS n, avg(len) AS mean, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM c),
i AS (SELECT *, CASE WHEN ln((n - da + 0.5) / (da + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - da + 0.5) / (da + 0.5)) END AS ia, CASE WHEN ln((n - db + 0.5) / (db + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - db + 0.5) / (db + 0.5)) END AS ib FROM s)
SELECT doc_id, round(ia * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * len / mean)) + ib * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * len / mean)), 6) AS score FROM c, i WHERE (a > 0 OR b > 0) AND source <> 'src0' ORDER BY score DESC, doc_id LIMIT 20
""")
def fulltext_ranked(spark, sf_dir):
    """The best documents for a word or a phrase, among those of all sources but one."""
    docs = table(spark, sf_dir, "documents").where("source <> 'src0'").select(F.col("doc_id").alias("doc"))
    best = _index(spark, sf_dir).ranked(T.either(T.word("erst"), T.phrase("of the")), docs)
    return best.select(F.col("doc").alias("doc_id"), F.round("score", 6).alias("score"))


_NAMES = "SELECT DISTINCT regexp_extract(url, '://([a-z0-9.-]+?)\\.example', 1) AS name FROM pages"


@query(f"WITH n AS ({_NAMES}) SELECT name, count(*) AS urls FROM n JOIN (SELECT DISTINCT url FROM pages) ON contains(url, name) WHERE name <> '' GROUP BY name")
def names_contained(spark, sf_dir):
    """In how many URLs each host's own name stands, anywhere."""
    pages = table(spark, sf_dir, "pages")
    names = pages.select(F.regexp_extract("url", r"://([a-z0-9.-]+?)\.example", 1).alias("name"))
    return N.contained(names, pages.select(F.col("url").alias("key"))).groupBy("name").agg(F.count("*").alias("urls"))


@query("""
WITH n AS (SELECT DISTINCT regexp_extract(url, '([^/]+)$', 1) AS name FROM pages WHERE page_id % 3 = 0)
SELECT name, count(*) AS urls FROM n JOIN (SELECT DISTINCT url FROM pages) ON ends_with(url, name) WHERE name <> '' GROUP BY name
""")
def names_as_suffix(spark, sf_dir):
    """Which URLs end with the last part of another."""
    pages = table(spark, sf_dir, "pages")
    names = pages.where("page_id % 3 = 0").select(F.regexp_extract("url", "([^/]+)$", 1).alias("name"))
    return N.as_suffix(names, pages.select(F.col("url").alias("key"))).groupBy("name").agg(F.count("*").alias("urls"))


_FILES = "SELECT DISTINCT substr(regexp_extract(url, '([^/?#]+)[^/]*$', 1), 1, 3) || '.md' AS file FROM pages"
_SONGS = "SELECT page_id AS place, CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '([^/?#]+)[^/]*$', 1) || '.md' ELSE regexp_extract(url, '([^/?#]+)[^/]*$', 1) || '-analysis.md' END AS key, 0.5 + page_id % 7 AS weight FROM pages"


@query(f"""
WITH f AS ({_FILES}), s AS ({_SONGS}), m AS (SELECT file, arg_min(weight, struct_pack(p := place, k := key)) AS weight FROM f JOIN s ON contains(key, file) OR contains(key, replace(file, '.md', '-analysis.md')) GROUP BY file)
SELECT file, coalesce(weight, 1.0)::DOUBLE AS weight FROM f LEFT JOIN m USING (file)
""")
def first_song_weights(spark, sf_dir):
    """The weight of the first entry whose key contains a file's name, or the name of its analysis; 1 where none does."""
    pages = table(spark, sf_dir, "pages")
    last = F.regexp_extract("url", "([^/?#]+)[^/]*$", 1)
    files = pages.select(F.concat(F.substring(last, 1, 3), F.lit(".md")).alias("file"))
    key = F.concat(last, F.when(F.col("page_id") % 2 == 0, ".md").otherwise("-analysis.md"))
    songs = pages.select(F.col("page_id").alias("place"), key.alias("key"), (0.5 + F.col("page_id") % 7).cast("double").alias("weight"))
    return N.first_weights(files, songs)
