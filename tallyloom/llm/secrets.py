"""Secret scans: what many owners hold is an example, what one owner holds is live. DataFrame functions only.

Base spans come from three patterns. Their values, and every other token that looks random (long, with letters and
digits), are candidates. Candidates are hashed, and the number of distinct repositories and owners that hold each hash
is counted over the whole corpus, after a first count within tasks. A candidate that few owners hold, in few repositories,
is live; one that many owners hold, or that stands in many repositories of however few owners, is an example that was
copied. Each place where a live value stands, in an assignment or not, is a span of its own kind unless a base span
covers it. Hashes, never the values, are shuffled, and a hash's rows are dealt over groups where they are judged.

Here a document's source is the owner, and source and language name the repository, unless the caller names a column
that does.

Defined results: a null text is empty and has no spans; a null source counts as an owner of its own; repeated rows count
once as owners and get equal results; a value seen with OWNERS owners or more, or in REPOS repositories or more, is an
example; a very long text is handled whole, in memory in proportion to its length and its matches and in time that
grows with matches as a sort does. Other columns aren't read, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

# Fixed patterns of the base spans.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: A token that may be a secret: 16 or more of these characters, tried once for each run of them.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+(?![A-Za-z0-9+/_=-])"
#: Kinds in the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "live")
#: From so many distinct owners on, a value counts as an example that was copied.
OWNERS = 3
#: From so many distinct repositories on, too, whoever owns them.
REPOS = 8


def places(text: Column, pattern: str) -> Column:
    """(start, end, value) of the matches, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    both = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda x, gap: F.struct(x.alias("x"), gap.alias("gap")))
    return once(both, lambda b: F.when(F.size(b) <= FEW, summed(b)).otherwise(summed_in_blocks(b)))


def once(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


#: Matches of a block. A running sum copies what it has so far at each step, so that a text with many matches would take
#: quadratic time; sums go block by block instead, and over the blocks.
FEW = 64
SPANS = "array<struct<start:int,end:int,value:string>>"


def summed(both: Column, base: Column | None = None) -> Column:
    """Spans from (x, gap): each match and the length of the text since the one before."""
    start = F.struct((F.lit(0) if base is None else base).alias("at"), F.expr(f"cast(array() as {SPANS})").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + m["gap"]
        end = begin + F.length(m["x"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), m["x"].alias("value")))).alias("out"))

    return F.aggregate(both, start, step)["out"]


def summed_in_blocks(both: Column) -> Column:
    def blocks_of(all_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / FEW).cast("int")), lambda i: F.slice(all_, i * FEW + 1, F.lit(FEW)))
        return F.transform(blocks, lambda b: F.struct(b.alias("b"), F.aggregate(b, F.lit(0), lambda acc, m: acc + m["gap"] + F.length(m["x"])).alias("size")))

    bases = lambda s: F.transform(s, lambda x, i: F.struct(x["b"].alias("b"), F.aggregate(F.slice(s, F.lit(1), i), F.lit(0), lambda acc, y: acc + y["size"]).alias("base")))
    return F.flatten(F.transform(once(blocks_of(both), bases), lambda x: summed(x["b"], x["base"])))


def of_kind(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), s["value"].alias("value")))


def looks_random(x: Column) -> Column:
    """Digits among letters, or a long token of letters that change case more than names do."""
    return (x.rlike("[0-9].*[0-9].*[0-9]") & x.rlike("[A-Za-z].*[A-Za-z].*[A-Za-z]")) | ((F.length(x) >= 32) & x.rlike("[a-z][A-Z]+[a-z]+[A-Z]+[a-z]+[A-Z]"))


def apart(tokens: Column, spans: Column) -> Column:
    """The tokens (start, end, value) that overlap none of the spans; both are sorted and disjoint, so only the span before a token and the one after it are looked at."""
    entry = lambda x, token: F.struct(x["start"].alias("start"), F.lit(token).alias("token"), x["end"].alias("end"), x["value"].alias("value"))

    def of(spans: Column) -> Column:
        merged = F.array_sort(F.concat(F.transform(spans, lambda x: entry(x, 0)), F.transform(tokens, lambda x: entry(x, 1))))
        placed = F.filter(F.transform(merged, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: p["x"]["token"] == 1)
        # of what stands before a token in the merged list, all but the tokens are spans
        ranked = F.transform(placed, lambda p, j: F.struct(p["x"]["start"].alias("start"), p["x"]["end"].alias("end"), p["x"]["value"].alias("value"), (p["i"] - j).alias("n")))
        free = F.filter(ranked, lambda t: F.coalesce(F.get(spans, t["n"] - 1)["end"] <= t["start"], F.lit(True)) & F.coalesce(F.get(spans, t["n"])["start"] >= t["end"], F.lit(True)))
        return F.transform(free, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["value"].alias("value")))

    return once(spans, of)


def scanned(docs: DataFrame, repo: str | None = None) -> DataFrame:
    """doc_id, owner, repo, base spans and candidate spans of every row; one scan, nothing shuffled. repo: a column that names the repository."""
    text = F.coalesce("text", F.lit(""))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    named = F.col(f"`{repo}`").cast("string") if repo else F.concat_ws("/", "source", "lang")
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("owner"), F.coalesce(named, F.lit("")).alias("repo"), text.alias("text"))
    value = lambda x: F.regexp_extract(x, ASSIGN, 2)
    assign = F.when(F.col("text").rlike(ASSIGN), F.filter(places(F.col("text"), ASSIGN), lambda s: F.length(value(s["value"])) >= 12)).otherwise(empty)
    access = F.when(F.col("text").contains("AKIA"), places(F.col("text"), ACCESS)).otherwise(empty)
    hexa = F.when(F.col("text").rlike(HEX), places(F.col("text"), HEX)).otherwise(empty)
    token = F.when(F.col("text").rlike(TOKEN), F.filter(places(F.col("text"), TOKEN), lambda s: looks_random(s["value"]))).otherwise(empty)
    rows = rows.select("doc_id", "owner", "repo", assign.alias("a"), access.alias("k"), hexa.alias("h"), token.alias("t"))
    base = F.array_sort(F.concat(of_kind(F.col("a"), "assign"), of_kind(F.col("k"), "access"), of_kind(F.col("h"), "hex")))
    hashed = lambda x: F.sha2(x, 256)
    plain = lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))
    rows = rows.withColumn("base", base)
    own = F.transform("base", lambda b: F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), hashed(F.when(b["rank"] == 0, value(b["value"])).otherwise(b["value"])).alias("hash")))
    bare = F.transform(reduce(apart, [F.col("a"), F.col("k"), F.col("h")], F.col("t")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), hashed(s["value"]).alias("hash")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repo", F.transform("base", plain).alias("base"), F.concat(own, bare).alias("candidates"))


def ownership(rows: DataFrame) -> DataFrame:
    """hash, owners, repos: in how many distinct owners' documents and repositories a candidate stands."""
    once = rows.select("owner", "repo", F.explode("candidates.hash").alias("hash")).distinct()
    repos = once.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return repos.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def listed(spans: Column) -> Column:
    """kind:start:end, by start, then kind as listed, comma-joined."""
    name = lambda s: reduce(lambda e, k: e.when(s["rank"] == k, KINDS[k]), range(1, len(KINDS)), F.when(s["rank"] == 0, KINDS[0]))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, owners: int = OWNERS, repos: int = REPOS, repo: str | None = None) -> DataFrame:
    """Every row's base spans, all its spans, and how many of its candidates are live or examples. docs: doc_id, text, source, lang, and the column repo if one is named."""
    rows = C.written(scanned(docs, repo))
    held = C.written(ownership(rows))
    each = rows.where(F.size("candidates") > 0).select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    judged = C.looked_up(each, held, "hash", F.col("row")).withColumn("live", (F.col("owners") < owners) & (F.col("repos") < repos))
    rank = KINDS.index("live")
    span = F.struct("start", F.lit(rank).alias("rank"), "end")
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live") & F.col("start").isNotNull(), span)).alias("more"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
    )
    out = rows.join(per_row, "row", "left")
    spans_type = out.schema["base"].dataType.simpleString()
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id",
        *[count(k) for k in KINDS[:3]],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", F.coalesce(F.col("more").cast(spans_type), F.array().cast(spans_type)))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
    )


def op9_secret_ownership(spark, sf_dir) -> DataFrame:
    return scan(C.table(spark, sf_dir, "documents"))
