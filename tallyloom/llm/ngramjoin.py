"""N-gram Jaccard join: an exact similarity join in the metric space of shingle sets.

1 - Jaccard similarity is a metric. Regions gather around pivots, and the triangle inequality says which documents of
one region can have a partner in another: if d(x, pivot) and d(y, pivot) differ by more than 1 - t, x and y are no link.

Sets of shingles are sparse: almost all documents are at distance 1 from almost all others, so a document must be
compared with pivots in its neighbourhood only. Which these are, prefix filtering tells without loss: with the
shingles of each document in one global order (common ones last), two sets that overlap enough share one of their first
n - ceil(t n) + 1 shingles. Each such shingle is a neighbourhood. The steps:

1. Equal sets become one class.
2. A class also has a sketch: how many of its shingles fall into each of PARTS parts by hash. The sum of the smaller
   counts of two sketches is never less than the intersection: the distance of sketches (Ruzicka's) never exceeds that
   of the sets. So pairs whose sketches are too far apart are dismissed without reading their sets.
3. In each neighbourhood, the class whose shingles are most common becomes the pivot, and all others are compared with
   it, if sizes and the shingle's places in both sets allow a link. A link joins the region of the pivot; the rest
   stays to be done.
4. Neighbourhoods with members left to be done recurse with a new pivot from these. Members that are already in its
   component, or outside the window that the triangle inequality leaves them by their distances to the last pivot,
   are not compared.
5. After ROUNDS pivots, the pairs that are still open in what remains of a neighbourhood are compared, under the same
   tests, by groups of at most about REGION x REGION pairs, so that no task holds a large neighbourhood.

So a group of thousands of near copies costs a comparison with its pivot for each member, not all pairs; and a link
between documents of different components is never lost. Components of all links come last.

Defined results: a null text or one without words has an empty set, and links with nothing; a text of fewer words than a
shingle has its whole sequence as its one shingle; repeated rows are equal sets; a very long text is handled whole, in
memory of about 100 bytes a word; an empty table gives no rows; of pivots that fit equally the one with the least hash
is taken, which changes no result. Shingles and classes are identified by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .components import components

#: Words of a shingle, and links' least percentage: percent * union <= 100 * intersection. Of the query, and of the stage.
SHINGLE, PERCENT = 4, 85
STAGE_SHINGLE, STAGE_PERCENT = 5, 80
ROUNDS = 2
#: Members of a neighbourhood's remainder that meet in one group, on either side.
REGION = 256
#: Share of documents in which shingles are counted, and how many of the most frequent ones order the rest. Which ones are
#: known changes costs, not results.
COUNTED, COMMON = 0.1, 1 << 20
#: Shingles that a task gathers before it counts them.
GATHER = 2_000_000
#: Bits of the map of documents whose sets are wanted.
BITS = 1 << 24
#: Parts of a sketch.
PARTS = 256


def sets(data: np.ndarray, offs: np.ndarray, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    data = C.LOWER[data]
    starts, ends, doc = C.spans(data, offs, C.NOT_SPACE)
    h = C.word_hashes(data, starts, ends)
    bounds = np.searchsorted(doc, np.arange(len(offs)))
    g = C.grams(h, n) if len(h) >= n else h
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        size = hi - lo
        if size >= n:
            out.append(np.unique(g[lo : hi - n + 1]))
        elif size:  # other hashes than those of n words
            out.append(C.mix(C.grams(h[lo:hi], size)[:1] + np.uint64(size)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def class_of(own: np.ndarray) -> int:
    """A hash of the set, in whatever order."""
    return int(C.mix(np.array([C.mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def sketch_of(own: np.ndarray) -> bytes | None:
    """The counts of the set's parts, a byte each; null if one doesn't fit."""
    count = np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=PARTS)
    return count.astype(np.uint8).tobytes() if count.max() < 256 else None


def batches_of_sets(batches, shingle: int):
    for batch in batches:
        for part in C.slices(batch):
            yield part, sets(*C.utf8(part.column("text")), shingle)


def common_shingles(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts; at most COMMON of them, whatever the corpus holds."""

    def count(batches):
        held, size = [], 0

        def out():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(C.signed(values)), pa.array(n, pa.int64())], names=["shingle", "n"])

        for _, own in batches_of_sets(batches, shingle):
            held += own
            size += sum(map(len, own))
            if size > GATHER:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    counts = docs.select("text").sample(COUNTED, seed=8).mapInArrow(C.released(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    counts = C.written(counts)
    level = F.least(F.col("n"), F.lit(1 << 16))
    least, size = 2, 0
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("v")).collect(), key=lambda r: -r["level"]):
        size += r["v"]
        if size > COMMON:
            least = r["level"] + 1
            break
    top = counts.where(F.col("n") >= least).toPandas()
    key, n = top["shingle"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(key)
    return key[order], n[order]


#: kind 0: a document (doc_id, n, x, sketch); kind 1: prefix shingles of a slice's classes that fall into a bucket; kind 2: those
#: that are known to be common.
SCANNED = "kind byte, doc_id long, n int, x long, sketch binary, bucket int, shingles array<long>, xs array<long>, ns array<int>, ats array<int>, pops array<float>"
MEMBER = "shingle long, x long, n int, at int, pop float"


def scanned(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], shingle: int, percent: int) -> DataFrame:
    """Written: SCANNED rows; the prefix of a class are its first n - ceil(t n) + 1 shingles; at: a shingle's place; pop: how common the class's shingles are."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    n_buckets = C.partitions(docs.sparkSession)
    lists = {"shingles": pa.int64(), "xs": pa.int64(), "ns": pa.int32(), "ats": pa.int32(), "pops": pa.float32()}

    def run(batches):
        known, count = shared.value
        done: set[int] = set()
        for part, own in batches_of_sets(batches, shingle):
            keys = [class_of(x) if len(x) else None for x in own]
            n_docs = len(own)
            columns: list[list] = [[], [], [], [], [], []]
            for x, key in zip(own, keys, strict=True):
                if key is None or key in done:
                    continue
                done.add(key)
                n = len(x)
                first = n + (-percent * n) // 100 + 1
                c = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                    c = np.where(known[at] == x, count[at], 0)
                order = np.argsort(c, kind="stable")[:first] if c.any() else np.arange(first)
                for column, value in zip(columns, (x[order], np.full(first, key), np.full(first, n), np.arange(first), np.full(first, np.log1p(c).mean()), c[order] > 0), strict=True):
                    column.append(value)
            if len(done) > 1 << 20:
                done.clear()
            rows = [pa.array(np.zeros(n_docs, np.int8)), part.column("doc_id"), pa.array([len(x) for x in own], pa.int32()), pa.array(keys, pa.int64()), pa.array([sketch_of(x) for x in own], pa.binary()), pa.nulls(n_docs, pa.int32()), *(pa.nulls(n_docs, pa.list_(t)) for t in lists.values())]
            names = [f.split(" ")[0] for f in SCANNED.split(", ")]
            yield pa.RecordBatch.from_arrays(rows, names=names)
            if columns[0]:
                s, key, n, at, pop, hot = (np.concatenate(c) for c in columns)
                bucket = np.where(hot, n_buckets, (C.mix(s) % np.uint64(n_buckets)).astype(np.int64))
                order = np.argsort(bucket, kind="stable")
                used, edges = np.unique(bucket[order], return_index=True)
                edges = pa.array(np.append(edges, len(order)), pa.int32())
                flat = [C.signed(s), key, n, at, pop]
                m = len(used)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(used == n_buckets, 2, 1), pa.int8()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(used, pa.int32())]
                    + [pa.ListArray.from_arrays(edges, pa.array(v[order], t)) for v, t in zip(flat, lists.values(), strict=True)],
                    names=names,
                )

    return C.written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(C.released(run), SCANNED), partition_by="kind")


def members_of(rows: DataFrame) -> DataFrame:
    """Written: MEMBER rows of shingles that stand in the prefixes of two classes or more.

    A bucket drops the shingles of one class only, which most are. Those that are known to be common don't pass
    through a bucket, so none holds a large group.
    """

    def shared(table: pa.Table) -> pa.Table:
        s, x, n, at, pop = (table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("shingles", "xs", "ns", "ats", "pops"))
        order = np.lexsort((x, s))
        s, x = s[order], x[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (x[1:] != x[:-1])  # copies of a class count once
        order, s, x = order[new], s[new], x[new]
        again = np.zeros(len(s) + 1, bool)
        again[1:-1] = s[1:] == s[:-1]
        keep = again[1:] | again[:-1]
        order = order[keep]
        return pa.Table.from_arrays([pa.array(s[keep]), pa.array(x[keep]), pa.array(n[order], pa.int32()), pa.array(at[order], pa.int32()), pa.array(pop[order], pa.float32())], names=["shingle", "x", "n", "at", "pop"])

    rare = rows.where("kind = 1").select("bucket", "shingles", "xs", "ns", "ats", "pops").groupBy("bucket").applyInArrow(shared, MEMBER)
    common = rows.where("kind = 2").select(F.explode(F.arrays_zip("shingles", "xs", "ns", "ats", "pops")).alias("m")).select(F.col("m.shingles").alias("shingle"), F.col("m.xs").alias("x"), F.col("m.ns").alias("n"), F.col("m.ats").alias("at"), F.col("m.pops").alias("pop"))
    return C.written(rare.unionByName(common))


def wanted_sets(docs: DataFrame, first: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """Written: (x, set) of the classes that stand in pairs (x, y), and of a few others; read from the first document of each class."""
    both = pairs.select("x").unionByName(pairs.select(F.col("y").alias("x"))).distinct()
    ids = both.join(first, "x").select(F.coalesce(F.pmod("first", F.lit(BITS)), F.lit(0)).alias("bit"))
    rows = ids.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toPandas()
    words = np.zeros(BITS // 64, np.uint64)  # a map of fixed size
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        def asked(batch):
            bit = np.asarray(batch.column("doc_id").fill_null(0)).astype(np.int64) % BITS
            return batch.filter(pa.array((shared.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1))

        for _, own in batches_of_sets((asked(b) for b in batches), shingle):
            found = {class_of(x): x for x in own if len(x)}
            if found:
                offs = np.cumsum([0, *map(len, found.values())])
                values = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(C.signed(np.concatenate(list(found.values())))))
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), values], names=["x", "set"])

    return C.written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(C.released(run), "x long, set array<long>"))


def plausible(pairs: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Written: the pairs (x, y) whose sketches allow a link."""

    def keep(batches):
        for batch in batches:
            a, b = batch.column("sketch").to_pylist(), batch.column("other").to_pylist()
            known = np.array([p is not None and q is not None for p, q in zip(a, b, strict=True)], bool)
            at = np.flatnonzero(known)
            u, v = (np.frombuffer(b"".join(s[i] for i in at), np.uint8).reshape(len(at), PARTS) for s in (a, b))
            most = np.minimum(u, v).sum(1, dtype=np.int64)
            ok = ~known
            ok[at] = (100 + percent) * most >= percent * (u.sum(1, dtype=np.int64) + v.sum(1, dtype=np.int64))
            yield batch.select(["x", "y"]).filter(pa.array(ok))

    s = first.select("x", "sketch")
    both = pairs.join(s, "x").join(s.select(F.col("x").alias("y"), F.col("sketch").alias("other")), "y")
    return C.written(both.select("x", "y", "sketch", "other").mapInArrow(C.released(keep), "x long, y long"))


def compared(docs: DataFrame, first: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Written: (x, y, d, link) with the exact distance of each pair."""
    own = wanted_sets(docs, first, pairs, shingle)
    other = own.select(F.col("x").alias("y"), F.col("set").alias("other"))
    both = pairs.join(own, "x").join(other, "y")
    shared = F.size(F.array_intersect("set", "other"))
    union = F.size("set") + F.size("other") - shared
    link = F.lit(100) * shared >= F.lit(percent) * union
    out = both.select("x", "y", (1 - shared / union).alias("d"), link.alias("link"))
    # pairs are made distinct in a step of its own, so that the joins can be split where a pivot has many rows
    return C.written(C.written(out).distinct())


def may_link(n1, at1, n2, at2, percent: int):
    """Whether sizes, and the places of a shared shingle that is the first one, allow a link."""
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    most = 1 + F.least(n1 - at1 - 1, n2 - at2 - 1)
    return (F.lit(100) * small >= F.lit(percent) * large) & (F.lit(100 + percent) * most >= F.lit(percent) * (n1 + n2))


def within_window(d1, d2, percent: int):
    """The triangle inequality; a distance that isn't known allows everything."""
    return F.coalesce(F.abs(d1 - d2) <= (100 - percent) / 100 + 1e-9, F.lit(True))


def links(docs: DataFrame, first: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(x, y) links that connect the same classes as all links do. first: (x, first, sketch) the first document of each class."""
    members = members.withColumns({"component": F.col("x"), "todo": F.lit(True), "d": F.lit(None).cast("double"), "home": F.lit(None).cast("long")})
    found = None
    for _ in range(ROUNDS):
        best = F.min(F.when(F.col("todo"), F.struct(-F.col("pop"), "x", "n", "at", "component", "d")))
        pivots = members.groupBy("shingle").agg(best.alias("p"), F.min("component").alias("a"), F.max("component").alias("b")).where("p IS NOT NULL AND a != b")
        pivots = pivots.select("shingle", *[F.col(f"p.{c}").alias(a) for c, a in (("x", "y"), ("n", "pn"), ("at", "pat"), ("component", "pc"), ("d", "pd"))])
        near = C.written(C.looked_up(members, C.written(pivots), "shingle", F.col("x")))
        fit = may_link(F.col("n"), F.col("at"), F.col("pn"), F.col("pat"), percent) & within_window(F.col("d"), F.col("pd"), percent)
        pairs = plausible(near.where((F.col("component") != F.col("pc")) & fit).select("x", "y").distinct(), first, percent)
        made = compared(docs, first, pairs, shingle, percent)
        new = made.where("link").select("x", "y")
        found = C.written(new if found is None else found.unionByName(new))
        label = components(found.select(F.col("x").alias("a"), F.col("y").alias("b")))
        # a pivot is done: it was compared with all that may link with it. The first one's component is the region's
        # home; members in it need no comparison with each other, all others stay to be done
        rest = near.where("x != y").withColumn("home", F.coalesce("home", "y")).drop("d", "component", "todo")
        rest = rest.join(label.select(F.col("node").alias("x"), F.col("label").alias("component")), "x", "left")
        rest = rest.join(label.select(F.col("node").alias("home"), F.col("label").alias("at_home")), "home", "left")
        rest = rest.withColumn("component", F.coalesce("component", "x")).withColumn("todo", F.col("component") != F.coalesce("at_home", "home"))
        left = rest.groupBy("shingle").agg(F.max("todo").alias("open"), F.count("*").alias("size")).where("open AND size > 1").select("shingle", "size")
        rest = C.looked_up(rest, C.written(left), "shingle", F.col("x")).join(made.select("x", "y", "d"), ["x", "y"], "left")
        members = C.written(rest.select("shingle", "x", "n", "at", "pop", "component", "todo", "d", "home", (F.floor(F.col("size") / REGION) + 1).cast("int").alias("parts")))
    # a remainder is dealt into parts; each part meets each other one in a group of its own, which has a bounded size
    part, parts = F.pmod(F.xxhash64("x"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    z = members.select("shingle", parts.alias("i"), part.alias("j"), *[F.col(c).alias(f"z_{c}") for c in ("x", "n", "at", "component", "todo", "d")])
    mine = members.where("todo").select("*", part.alias("i"), parts.alias("j"))
    pairs = mine.join(z, ["shingle", "i", "j"]).where((F.col("component") != F.col("z_component")) & (~F.col("z_todo") | (F.col("x") < F.col("z_x"))))
    pairs = pairs.where(may_link(F.col("n"), F.col("at"), F.col("z_n"), F.col("z_at"), percent) & within_window(F.col("d"), F.col("z_d"), percent))
    pairs = plausible(pairs.select("x", F.col("z_x").alias("y")).distinct(), first, percent)
    return found.unionByName(compared(docs, first, pairs, shingle, percent).where("link").select("x", "y"))


def joined(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    C.bounded_batches(docs.sparkSession)
    rows = scanned(docs, common_shingles(docs, shingle), shingle, percent)
    own = rows.where("kind = 0").select("doc_id", "n", "x")
    first = C.written(rows.where("kind = 0 AND x IS NOT NULL").groupBy("x").agg(F.min("doc_id").alias("first"), F.first("sketch").alias("sketch")))
    label = components(links(docs, first, members_of(rows), shingle, percent).select(F.col("x").alias("a"), F.col("y").alias("b")))
    first = first.drop("sketch").join(label.select(F.col("node").alias("x"), "label"), "x", "left").withColumn("label", F.coalesce("label", "x"))
    least = first.groupBy("label").agg(F.min("first").alias("component_id"))
    to = first.join(least, "label").select("x", "component_id")
    out = own.join(to, "x", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op8_ngram_jaccard(spark, sf_dir) -> DataFrame:
    return joined(C.table(spark, sf_dir, "documents"))


def numbered_rows(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with a number of its own for each row, as doc_id, and its columns under names that are given back. Rows of files are numbered by file and place, where they stand; others are written first."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)]
    spread = lambda n: n + F.shiftright(n, 33) * 10368889  # noqa: E731  so that rows of all files or partitions spread over a map of BITS
    try:
        placed = docs.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    except AnalysisException:
        return C.written(docs.select(spread(F.monotonically_increasing_id()).alias("doc_id"), *columns)), names
    files = placed.select("file").distinct().withColumn("at", F.row_number().over(Window.orderBy("file")).cast("long"))  # a row for each file
    both = C.looked_up(placed, C.written(files), "file", F.col("place"))
    return both.select(spread(F.shiftleft("at", 33) + F.col("place")).alias("doc_id"), *names), names


def stage_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that with the smallest doc_id, a null one last. Rows are told apart by a number of their own, so unlike rows that share a doc_id both stay."""
    rows, names = numbered_rows(docs)
    id_, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    found = joined(rows.select("doc_id", text.alias("text")), STAGE_SHINGLE, STAGE_PERCENT).select("doc_id", "component_id")
    of = C.written(found.join(rows.select("doc_id", id_.alias("id")), "doc_id"))
    keep = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc_id"))["doc_id"].alias("kept")
    least = C.written(of.groupBy("component_id").agg(keep, F.count("*").alias("size")).where("size > 1").select("component_id", "kept"))
    gone = C.written(C.looked_up(of, least, "component_id", F.col("doc_id")).where("doc_id != kept").select("doc_id"))
    return C.renamed(C.without(rows, gone, "doc_id"), names, docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(w[i:i + 3]) AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.other = edge.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
