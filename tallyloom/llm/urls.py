"""URL filters: rules first, then gradient-boosted trees on lexical features of the URL.

Labelled URLs are those that a rule decides, or a given table of (url, blocked). The trees are trained on at most
TRAIN_ROWS of them, chosen by the hash of the URL, with both labels weighing alike, and judge every other URL.

Features: length of host, path and query, depth of host and path, share of digits, of letters and of hyphens, entropy
of the host's and the path's characters, number of query parameters, whether a port, an address or an encoded
character stands in it, and statistics of its parts: for the host's last label (its suffix), the last two labels, the
first folder and the first query key, how many labelled URLs share it and how many of those are blocked. Parts fall into
BUCKETS buckets by hash, which all have their statistics, however many parts there are. `held_out_accuracy` trains on four
fifths of the labelled URLs and judges the others. Each URL is learned from twice, once as if no label had its host.

Defined results: a null URL, or one without `://`, has empty host and path and matches no rule; without labelled URLs
of both kinds the method allows everything, or blocks everything if that is all it has seen; equal URLs get equal
results; a very long URL is handled whole; other columns aren't read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Rules of the query: verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Labelled URLs that the trees are trained on, at most (about).
TRAIN_ROWS = 20_000
#: Buckets of each kind of part; weight of the prior in a part's share of blocked URLs, in URLs.
BUCKETS, PRIOR_ROWS = 4096, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """host (A-Z lower-cased), path, query."""
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path, F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1)


def deciding_rule(host: Column, path: Column, rules) -> Column:
    """The longest rule (host and path, then the first listed) that fits, as a struct; null if none does.

    The rules are an argument that the caller lists, so they are part of the plan; nothing is joined.
    """
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    best = F.coalesce(*[
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ], none) if rules else none
    return best


def entropy(x: Column) -> Column:
    chars = F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))
    n = F.greatest(F.length(x), F.lit(1))
    share = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda d: d == c)) / n)
    return F.aggregate(share, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def features(rows: DataFrame) -> DataFrame:
    """rows (url, host, path, query) with the lexical features f_*."""
    url, host, path, query = (F.coalesce(F.col(c), F.lit("")) for c in ("url", "host", "path", "query"))
    count = lambda x, p: F.regexp_count(x, F.lit(p)).cast("double")
    size = F.greatest(F.length(url), F.lit(1))
    return rows.withColumns({
        "f_length": F.length(url).cast("double"),
        "f_host": F.length(host).cast("double"),
        "f_path": F.length(path).cast("double"),
        "f_query": F.length(query).cast("double"),
        "f_labels": count(host, "\\."),
        "f_depth": count(path, "/"),
        "f_digits": count(url, "[0-9]") / size,
        "f_letters": count(url, "[A-Za-z]") / size,
        "f_hyphens": count(host, "-"),
        "f_host_entropy": entropy(host),
        "f_path_entropy": entropy(path),
        "f_params": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "f_port": host.rlike(":[0-9]+$").cast("double"),
        "f_address": host.rlike("^[0-9.]+$").cast("double"),
        "f_encoded": count(url, "%[0-9A-Fa-f]{2}"),
        "f_secure": url.startswith("https").cast("double"),
        **{f"part_{k}": bucket(v) for k, v in parts_of(host, path, query).items()},
    })


def parts_of(host: Column, path: Column, query: Column) -> dict[str, Column]:
    """The parts that have statistics."""
    return {"suffix": F.substring_index(host, ".", -1), "site": F.substring_index(host, ".", -2), "folder": F.lower(F.regexp_extract(path, "^/([^/]*)", 1)), "key": F.regexp_extract(query, "^([^=&]*)", 1)}


def bucket(part: Column) -> Column:
    return F.pmod(F.xxhash64(part), F.lit(BUCKETS)).cast("int")


PARTS = ("suffix", "site", "folder", "key")
FEATURES = ("length", "host", "path", "query", "labels", "depth", "digits", "letters", "hyphens", "host_entropy", "path_entropy", "params", "port", "address", "encoded", "secure", *(f"{p}_{s}" for p in PARTS for s in ("share", "blocked")))


class Model:
    """Trees and statistics of parts; both have a bounded size."""

    def __init__(self, labelled: DataFrame, train_rows: int = TRAIN_ROWS):
        """labelled: url, host, path, query, blocked (boolean)."""
        total = labelled.agg(F.count("*").alias("n"), F.count_if("blocked").alias("bad")).first()
        n, bad = total["n"], total["bad"]
        self.prior = bad / n if n else 0.0
        self.share, self.bad = {p: [0.0] * BUCKETS for p in PARTS}, {p: [self.prior] * BUCKETS for p in PARTS}
        by_part = parts_of(*(F.coalesce(c, F.lit("")) for c in ("host", "path", "query")))
        rows = labelled.select("blocked", F.explode(F.array(*[F.struct(F.lit(p).alias("part"), bucket(by_part[p]).alias("bucket")) for p in PARTS])).alias("p"))
        # at most BUCKETS rows for each kind of part
        for r in rows.groupBy("p.part", "p.bucket").agg(F.count("*").alias("n"), F.count_if("blocked").alias("bad")).collect():
            self.share[r["part"]][r["bucket"]] = r["n"] / n
            self.bad[r["part"]][r["bucket"]] = (r["bad"] + PRIOR_ROWS * self.prior) / (r["n"] + PRIOR_ROWS)
        self.trees = None
        if 0 < bad < n:
            keep = F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, train_rows / n))
            # each URL twice, once as one whose host no label has, so that the trees learn what to make of such
            some = labelled.where(keep)
            sample = self.vectors(some).unionByName(self.vectors(some, known_hosts=False)).withColumn("label", F.col("blocked").cast("double"))
            sample = sample.withColumn("weight", F.when(F.col("blocked"), n / (2 * bad)).otherwise(n / (2 * (n - bad))))
            if sample.agg(F.countDistinct("label")).first()[0] == 2:
                self.trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=20, maxDepth=4, maxBins=64, seed=7).fit(sample.select("x", "label", "weight"))

    def vectors(self, rows: DataFrame, known_hosts: bool = True) -> DataFrame:
        """rows with features and their vector, x. Without known hosts, the parts of the host get the statistics of parts that no label has."""
        of = lambda values, at: F.get(F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>"), F.col(at))
        rows = features(rows).withColumns({
            f"f_{p}_{name}": of(values[p], f"part_{p}") if known_hosts or p not in ("suffix", "site") else F.lit(unseen)
            for p in PARTS
            for name, values, unseen in (("share", self.share, 0.0), ("blocked", self.bad, self.prior))
        })
        return VectorAssembler(inputCols=[f"f_{c}" for c in FEATURES], outputCol="x").transform(rows)

    def blocked(self, rows: DataFrame) -> DataFrame:
        """rows with p_blocked."""
        if self.trees is None:
            return rows.withColumn("p_blocked", F.lit(float(self.prior >= 0.5)))
        made = self.trees.transform(self.vectors(rows))
        return made.select(*rows.columns, vector_to_array("probability")[1].alias("p_blocked"))


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, query, decided (the deciding rule, or null) of every row."""
    host, path, query = parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), query.alias("query"))
    return rows.withColumn("decided", deciding_rule(F.col("host"), F.col("path"), rules))


def labelled_by_rules(rows: DataFrame) -> DataFrame:
    return rows.where("decided IS NOT NULL").withColumn("blocked", F.col("decided.verdict") == "block")


def held_out_accuracy(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[float, float]:
    """The shares of blocked and of allowed URLs that a model which hasn't seen them judges right; a fifth of the URLs, by hash, is held out."""
    out = F.pmod(F.xxhash64("url", F.lit("held out")), F.lit(5)) == 0
    judged = Model(labelled.where(~out), train_rows).blocked(labelled.where(out)).select("blocked", (F.col("p_blocked") >= 0.5).alias("said"))
    got = judged.agg(F.avg(F.when(F.col("blocked"), F.col("said").cast("double"))).alias("b"), F.avg(F.when(~F.col("blocked"), (~F.col("said")).cast("double"))).alias("a")).first()
    return got["b"], got["a"]


def judged(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, p_blocked (the method's probability) of every row."""
    rows = ruled(pages, rules)
    if labelled is None:
        labelled = labelled_by_rules(rows)
    else:
        host, path, query = parts(F.col("url"))
        labelled = labelled.select("url", host.alias("host"), path.alias("path"), query.alias("query"), F.col("blocked"))
    out = Model(labelled).blocked(rows)
    verdict = F.coalesce("decided.verdict", F.when(F.col("p_blocked") >= 0.5, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("decided.rule").alias("rule"), verdict.alias("verdict"), "p_blocked")


def op10_url_filter(spark, sf_dir) -> DataFrame:
    return judged(C.table(spark, sf_dir, "pages"))
