"""Operators on a corpus of documents: duplicates, gates, weights, retrieval, term statistics.

All are functions from DataFrames to a DataFrame; ties are broken by doc_id. Terms, weights and thresholds are
arguments that the caller lists, so they are part of the plan and not joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scoring as S
from ..functions import text as X


def duplicate_clusters(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """content_hash, n, first_id of texts that are equal but for case and white space, two and more."""
    return docs.groupBy(F.md5(X.normalised(F.col(text))).alias("content_hash")).agg(F.count("*").alias("n"), F.min(key).alias("first_id")).where("n > 1")


def keep_first(docs: DataFrame, content: Column, key: str = "doc_id") -> DataFrame:
    """key, content_hash, kept: only the first row of equal content is kept. The first one comes from an aggregate, so a common content doesn't meet in one task."""
    rows = docs.select(key, content.alias("content_hash"))
    first = rows.groupBy("content_hash").agg(F.min(key).alias("first_id"))
    return rows.join(first, "content_hash").select(key, "content_hash", (F.col(key) == F.col("first_id")).alias("kept"))


def compaction(docs: DataFrame) -> DataFrame:
    """One row: how many are duplicates, empty or stubs among the rest, and the bytes that all of these hold."""
    rows = docs.select("doc_id", "text", F.md5(X.normalised(F.col("text"))).alias("content_hash"))
    first = rows.groupBy("content_hash").agg(F.min("doc_id").alias("first_id"))
    kind = F.when(F.col("doc_id") != F.col("first_id"), "duplicate").when(F.trim("text") == "", "empty").when(X.is_stub(F.col("text")), "stub").otherwise("kept")
    flagged = rows.join(first, "content_hash").select(kind.alias("kind"), F.octet_length("text").alias("bytes"))
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{k}")
    return flagged.agg(count("duplicate"), count("empty"), count("stub"), count("kept"), F.coalesce(F.sum(F.when(F.col("kind") != "kept", F.col("bytes"))), F.lit(0)).alias("bytes_freed"))


def quality_gate(docs: DataFrame, dead_words: int = 50) -> DataFrame:
    """By source: documents, dead ones (few body words), repeated titles (first lines), bytes, verdict."""
    rows = docs.select("source", X.body_words(F.col("text")).alias("words"), F.octet_length("text").alias("bytes"), F.split("text", "\n")[0].alias("title"))
    titles = rows.groupBy("source", "title").agg(F.count("*").alias("n"), F.count_if(F.col("words") < dead_words).alias("dead"), F.sum("bytes").alias("bytes"))
    gate = titles.groupBy("source").agg(F.sum("n").alias("total"), F.sum("dead").alias("dead"), F.sum(F.col("n") - 1).alias("repeated_titles"), F.sum("bytes").alias("bytes"))
    ratio = F.col("dead") / F.col("total")
    verdict = F.when(F.col("total") == 0, "EMPTY").when(ratio > 0.5, "FAIL").when(ratio > 0.2, "WARNING").otherwise("PASS")
    return gate.select("source", "total", (F.col("total") - F.col("dead")).alias("passed"), "dead", "repeated_titles", "bytes", verdict.alias("verdict"))


def blended_weights(docs: DataFrame, static: Mapping[str, float]) -> DataFrame:
    """By source: half a given weight, half one from the source's median length over the median of these; both drawn towards 1."""
    medians = docs.groupBy("source").agg(F.median(F.length("text") / 1024).alias("m"))
    overall = medians.agg(F.median("m").alias("overall"))
    pull = lambda c: 1.0 + (c - 1.0) * P.COMPRESSION
    given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in static.items()] or [("", 1.0)], "source string, given double")
    data = medians.join(F.broadcast(overall)).select("source", F.when(F.col("overall") > 0, pull(F.col("m") / F.col("overall"))).alias("data"))
    both = data.join(F.broadcast(given), "source", "full_outer").where("source != ''")
    raw = F.coalesce(pull(F.col("given")), F.lit(1.0)) * (1 - P.BLEND) + F.coalesce("data", F.lit(1.0)) * P.BLEND
    return both.select("source", F.bround(F.greatest(F.lit(P.FLOOR), F.least(raw, F.lit(P.CEILING))), 2).alias("weight"))


def matched(text: Column, terms: Mapping[str, float]) -> Column:
    """Sum of the weights of the terms that the text contains, whatever their case."""
    low = F.lower(text)
    return sum((F.when(low.contains(t.lower()), F.lit(w)).otherwise(0.0) for t, w in terms.items()), F.lit(0.0))


def expanded_terms(query: str, stem, synonyms: Mapping[str, Sequence[str]]) -> dict[str, float]:
    """A query's words with weight 1, their stems with 0.7, synonyms' words with 0.5; the first weight of a word counts."""
    raw = query.lower().split()
    found: dict[str, float] = {}
    layers = ((raw, 1.0), ([s for w in raw if (s := stem(w)) and s != w], 0.7), ([p for w in raw for s in synonyms.get(w, ()) for p in s.lower().split()], 0.5))
    for layer, weight in layers:
        for word in layer:
            found.setdefault(word, weight)
    return found


def first_weight(path: Column, weights: Mapping[str, float]) -> Column:
    """The weight of the first listed key that the path contains; 1 without one."""
    return F.coalesce(*[F.when(path.contains(k), F.lit(float(w))) for k, w in weights.items()], F.lit(1.0))


def domain_boost(path: Column, terms: Sequence[str], domains: Mapping[str, Sequence[str]]) -> Column:
    """The best boost among sources that the path contains: for each query term that fits one of the source's words."""
    fits = lambda q, d: q == d or (len(q) > 3 and q in d) or (len(d) > 3 and d in q)
    best = F.lit(0.0)
    for key, words in domains.items():
        hits = sum(any(fits(t.lower(), w) for w in words) for t in terms)
        if hits:
            best = F.greatest(best, F.when(path.contains(key), F.lit(min(hits * P.BOOST_PER_HIT, P.BOOST_CAP))).otherwise(0.0))
    return best


def ranked(docs: DataFrame, terms: Mapping[str, float], weight: Column, recency: Column, top: int = 20) -> DataFrame:
    """doc_id, score, rank of documents that contain a term.

    The order is that of match x weight; then the first `top` rows are scored anew as match x recency and sorted among
    themselves, and only they are returned (`ranked_all` has the rest, too). So the dynamic weight decides who is eligible
    and ties, no more.
    """
    found = docs.withColumn("matched", matched(F.col("text"), terms)).where("matched > 0").select("doc_id", "matched", weight.alias("weight"), recency.alias("recency"))
    # only the first rows need a total order among all; a limit finds them without sorting the rest
    head = found.orderBy(F.desc(F.col("matched") * F.col("weight")), "doc_id").limit(top)
    head = head.withColumn("pre", F.row_number().over(Window.orderBy(F.desc(F.col("matched") * F.col("weight")), "doc_id")))
    scored = head.select("doc_id", (F.col("matched") * F.col("recency")).alias("score"), "pre")
    return scored.select("doc_id", "score", F.row_number().over(Window.orderBy(F.desc("score"), "pre")).cast("long").alias("rank"))


def ranked_all(docs: DataFrame, terms: Mapping[str, float], weight: Column, recency: Column, top: int = 20) -> DataFrame:
    """doc_id, bucket, score of all documents that contain a term: the rows of `ranked` in bucket 0, the others in bucket 1 with match x weight; order by bucket, then score. Nothing is sorted as a whole."""
    head = ranked(docs, terms, weight, recency, top).select("doc_id", F.lit(0).alias("bucket"), "score")
    found = docs.withColumn("matched", matched(F.col("text"), terms)).where("matched > 0").select("doc_id", F.lit(1).alias("bucket"), (F.col("matched") * weight).alias("score"))
    return head.unionByName(found.join(F.broadcast(head.select("doc_id")), "doc_id", "left_anti"))  # at most top rows


def capped(rows: DataFrame, group: str, order: Sequence[Column], most: int = 3) -> DataFrame:
    """At most so many rows of each group; rows without a group stay."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.where(F.col(group).isNotNull()).withColumn("place", place).where(F.col("place") <= most).drop("place").unionByName(rows.where(F.col(group).isNull()))


def packed(rows: DataFrame, order: str, text: str, budget: int) -> DataFrame:
    """Rows in their order while they fit into a budget of characters; the first that doesn't is cut, if over 200 characters are left, and ends the list.

    rows: a ranked result list, which is short.
    """
    before = F.coalesce(F.sum(F.length(text)).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fits = before + F.length(text) <= budget
    out = rows.withColumn("before", before).withColumn("fits", fits)
    out = out.withColumn("over", F.sum(F.when(~F.col("fits"), 1).otherwise(0)).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    left = F.lit(budget) - F.col("before")
    kept = out.where("fits AND over = 0 OR NOT fits AND over = 1").where(F.col("fits") | (left > 200))
    return kept.withColumn(text, F.when(F.col("fits"), F.col(text)).otherwise(F.left(text, left))).drop("before", "fits", "over")


def postings(docs: DataFrame, terms: Sequence[str] | None = None) -> DataFrame:
    """term, doc_id, tf, length; of all terms, or of some. Terms are runs of letters and digits, in lower case."""
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))
    rows = docs.select("doc_id", found.alias("words")).withColumn("length", F.size("words").cast("long"))
    if terms is not None:
        wanted = F.array(*[F.lit(t) for t in terms])
        rows = rows.withColumn("words", F.filter("words", lambda w: F.array_contains(wanted, w)))
    return rows.select("doc_id", "length", F.explode("words").alias("term")).groupBy("term", "doc_id", "length").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, terms: Sequence[str], top: int = 20, digits: int = 9) -> DataFrame:
    """doc_id, score of the best documents that hold all terms. Scores are rounded first, so those that are equal as given go by doc_id, a null one last."""
    rows = docs.select("doc_id", F.lower("text").alias("low"))
    of = lambda pattern: F.regexp_count("low", F.lit(pattern)).cast("long")
    tf = lambda t: F.when(F.col("low").contains(t), of(f"(?<![a-z0-9]){t}(?![a-z0-9])")).otherwise(F.lit(0).cast("long"))
    counted = rows.select("doc_id", of("[a-z0-9]++").alias("length"), *[tf(t).alias(f"tf{i}") for i, t in enumerate(terms)])
    stats = counted.agg(F.count("*").alias("n"), F.avg("length").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    both = counted.where(" AND ".join(f"tf{i} > 0" for i in range(len(terms)))).join(F.broadcast(stats))  # one row
    score = sum((S.bm25_part(F.col(f"tf{i}"), F.col("length"), F.col("mean"), F.col("n"), F.col(f"df{i}")) for i in range(len(terms))), F.lit(0.0))
    return both.select("doc_id", F.round(score, digits).alias("score")).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")).limit(top)


def term_statistics(docs: DataFrame, stop: Sequence[str] = ()) -> DataFrame:
    """doc_id, term, count, total (terms of the document); counted within each row, nothing is shuffled."""
    rows = docs.select("doc_id", X.concept_tokens(F.col("text"), tuple(stop)).alias("terms"))
    rows = rows.select("doc_id", F.size("terms").alias("total"), F.explode(X.tallied(F.col("terms"))).alias("t"))
    return rows.select("doc_id", F.col("t.word").alias("term"), F.col("t.n").alias("count"), "total")


def concepts(docs: DataFrame, stop: Sequence[str] = (), least_df: int = 10, most_share: float = 0.4, most: int = 200, least_score: float = 0.01) -> DataFrame:
    """term, df, score: the terms with the largest sums of tf-idf, neither rare nor common; the least score counts after the cut."""
    n = docs.count()
    by_term = term_statistics(docs, stop).groupBy("term").agg(F.count("*").alias("df"), F.sum(F.col("count") / F.col("total")).alias("tf"))
    band = by_term.where((F.col("df") >= least_df) & (F.col("df") <= int(n * most_share)))
    # idf is the same for all documents of a term, so it multiplies the sum
    scored = band.select("term", "df", F.round(F.col("tf") * S.idf(F.lit(n), F.col("df")), 6).alias("score"))
    return scored.orderBy(F.desc("score"), "term").limit(most).where(F.col("score") >= least_score)


def keywords(docs: DataFrame, group: str, each: int = 20, most: int = 30, least: int = 4) -> DataFrame:
    """By group: the keywords with the largest sums of counts over documents, of each document's own top terms."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(f"[a-z]{{{least},}}"), F.lit(0))
    first = lambda t: F.struct((-t["n"]).alias("n"), t["word"].alias("word"))
    own = F.slice(F.sort_array(F.transform(X.tallied(words), first)), 1, each)
    total = docs.select(group, F.explode(own).alias("t")).groupBy(group, F.col("t.word").alias("word")).agg((-F.sum("t.n")).alias("n"))
    return total.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "word")).cast("long")).where(F.col("place") <= most)


def profile_overlaps(profiles: DataFrame, key: str, item: str, least: float = 0.0) -> DataFrame:
    """Pairs of keys (a < b) with the Jaccard similarity of their items, where they share any.

    Keys are few (sources, skills); pairs come from a join on items, so only keys that share one meet.
    """
    items = profiles.select(F.col(key).alias("k"), F.col(item).alias("i")).distinct()
    sizes = items.groupBy("k").agg(F.count("*").alias("n"))
    by_item = items.groupBy("i").agg(F.array_sort(F.collect_set("k")).alias("ks"))
    pairs = by_item.select(F.posexplode("ks").alias("p", "a"), "ks").select("a", F.explode(F.slice("ks", F.col("p") + 2, F.greatest(F.size("ks") - F.col("p") - 1, F.lit(0)))).alias("b")).groupBy("a", "b").agg(F.count("*").alias("shared"))
    out = pairs.join(sizes.select(F.col("k").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("k").alias("b"), F.col("n").alias("nb")), "b")
    return out.select("a", "b", "shared", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 6).alias("jaccard")).where(F.col("jaccard") >= least)


def greedy_clusters(overlaps: DataFrame, sizes: DataFrame, least: float = 0.5) -> DataFrame:
    """source, cluster: keys in order of size; each free one takes the free keys that overlap it by more than `least`.

    overlaps: a, b, jaccard; sizes: k, n. The pass is one over the keys (sources), which are few; it runs in one task.
    """

    def cluster(pdf):
        near: dict[str, set[str]] = {}
        for a, b in zip(pdf["k"], pdf["b"], strict=True):
            if isinstance(b, str):
                near.setdefault(a, set()).add(b)
        order = pdf[["k", "n"]].drop_duplicates().sort_values(["n", "k"], ascending=[False, True])["k"].tolist()
        of: dict[str, int] = {}
        for seed in order:
            if seed not in of:
                number = len(set(of.values())) + 1
                of |= {k: number for k in order if k not in of and (k == seed or k in near.get(seed, ()))}
        return type(pdf)({"source": list(of), "cluster": list(of.values())})

    both = overlaps.where(F.col("jaccard") > least).select("a", "b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rows = sizes.select("k", "n").join(both.withColumnRenamed("a", "k"), "k", "left").withColumn("all", F.lit(1))
    return rows.groupBy("all").applyInPandas(cluster, "source string, cluster long")


def distinct_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line, pos: each line of a document at its first place."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.groupBy("doc_id", "line").agg(F.min("pos").cast("long").alias("pos"))


def repeated_lines(docs: DataFrame, least_chars: int = 20) -> DataFrame:
    """doc_id, line, n: longer lines that a document repeats."""
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.length(F.trim("line")) > least_chars)
    return lines.groupBy("doc_id", "line").agg(F.count("*").alias("n")).where("n > 1")


def chunks(docs: DataFrame, words: int = 500) -> DataFrame:
    """doc_id, chunk, text: sentences gathered up to so many words; a longer sentence is a chunk of its own."""
    parts = F.transform(X.sentences(F.col("text")), lambda s: F.struct(s.alias("s"), F.size(X.words(s)).alias("n")))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("now"), F.lit(0).alias("n"))

    def add(acc: Column, p: Column) -> Column:
        full = acc["now"].isNotNull() & (acc["n"] + p["n"] > words)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(acc["now"]))).otherwise(acc["done"]).alias("done"),
            F.when(full, p["s"]).otherwise(F.concat_ws(" ", acc["now"], p["s"])).alias("now"),
            F.when(full, p["n"]).otherwise(acc["n"] + p["n"]).alias("n"),
        )

    all_ = F.aggregate(parts, start, add, lambda acc: F.when(acc["now"].isNotNull(), F.concat(acc["done"], F.array(acc["now"]))).otherwise(acc["done"]))
    return docs.select("doc_id", F.posexplode(all_).alias("chunk", "text"))


def even_sample(docs: DataFrame, group: str, most: int = 50) -> DataFrame:
    """About `most` rows of each group, evenly spread over doc_id."""
    w = Window.partitionBy(group)
    rows = docs.withColumn("place", F.row_number().over(w.orderBy("doc_id"))).withColumn("size", F.count("*").over(w))
    step = F.greatest(F.lit(1), F.floor(F.col("size") / most))
    return rows.where(((F.col("place") - 1) % step == 0) & ((F.col("place") - 1) / step < most)).drop("place", "size")
