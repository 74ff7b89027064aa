"""Harmonic packing of tokenised documents into sequences of CAPACITY tokens.

A document is cut into whole sequences, then the rest into pieces of a half, a quarter ... of a sequence down to TAIL
tokens, and one last piece below TAIL. Class j holds the pieces of more than CAPACITY / (j + 1) and at most
CAPACITY / j tokens, and every bin of class j takes j of them, whichever they are. So a bin needs no search: a piece's
number within its class gives its bin and its place there, and workers fill bins without knowing each other's pieces.
Bins of the classes 1, 2, 4 ... are full to the last token; only last pieces leave padding, below TAIL / CAPACITY of
their bins.

Numbers within a class come from each task's own count and the sum over earlier tasks (a window over one row for each
task and class). The one bin of each class that stays incomplete (fewer than CAPACITY pieces of any class, whatever
the corpus) is packed again by next fit, those of all classes together.

Defined results: a null or empty text has the one token id END; a piece never spans documents; repeated rows are
packed as many times; an empty table gives no rows; a very long text is tokenised whole, in memory of about 50 bytes a token; other columns are not read. A document's pieces may lie in several sequences.
"""

from __future__ import annotations

from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

CAPACITY = 1024
TAIL = 64
END = 0


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def encoder(path: str):
    """A function from texts to lists of ids.

    The ids are those of the tokenizers library for the file at path. Its vocabulary is handed to tiktoken, which
    merges the same byte pairs several times faster; texts that hold the string of an added token, which the
    library takes for that token, go to the library itself. Files of another kind go to the library altogether.
    """
    import json

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    slow = lambda texts: [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not model.get("dropout") and not model.get("end_of_word_suffix")
    if not plain:
        return slow
    import public_tokenizers
    import tiktoken

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in printable} | {chr(256 + i): c for i, c in enumerate(x for x in range(256) if x not in printable)}
    added = [t["content"] for t in spec.get("added_tokens", [])]
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("from_file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [slow([x])[0] if any(a in x for a in added) else fast.encode_ordinary(x) for x in texts]

    return encode


def cuts(n: int) -> list[int]:
    """Lengths of the pieces of n tokens, in order."""
    out = [CAPACITY] * (n // CAPACITY)
    rest, part = n % CAPACITY, CAPACITY // 2
    while rest:
        if part < TAIL:
            out.append(rest)
            break
        if rest >= part:
            out.append(part)
            rest -= part
        part //= 2
    return out


def pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row for each piece, with its class and its number among the task's pieces of that class."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, task long, number long"

    def cut(batches):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encode, task = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(CAPACITY + 1, np.int64)
        for batch in batches:
            for part in C.slices(batch):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = np.array([*encode([text or ""])[0], END], "<u4")
                    at = 0
                    for size in cuts(len(ids)):
                        j = CAPACITY // size
                        rows.append((doc_id, at, size, crc32(ids[at : at + size].tobytes()), len(ids), j, task, seen[j]))
                        seen[j] += 1
                        at += size
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 5 else pa.int64()) for i, c in enumerate(columns)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "task", "number"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(C.released(cut), schema)


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    cut = C.written(pieces(docs, tokenizer))
    # one row for each task and class; classes are at most TAIL + log2(CAPACITY), whatever the corpus
    count = cut.groupBy("class", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = count.select("class", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    total = {r["class"]: r["n"] for r in cut.groupBy("class").agg(F.count("*").alias("n")).collect()}
    starts, full, at = {}, {}, 0
    for j, n in sorted(total.items()):
        starts[j], full[j] = at, n // j
        at += n // j
    lookup = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[F.col("class")] if m else F.lit(0)
    placed = cut.join(base, ["class", "task"]).withColumn("global", F.col("before") + F.col("number"))
    placed = placed.withColumns({"bin": F.floor(F.col("global") / F.col("class")).cast("long"), "slot": F.col("global") % F.col("class")})
    whole = placed.where(F.col("bin") < lookup(full)).withColumn("sequence_id", (lookup(starts) + F.col("bin")).cast("long"))
    in_bin = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = whole.withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0))).select(*columns)

    def next_fit(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "start", "global"], ascending=[False, True, True, True], kind="stable")
        bins, filled, seq, off = at, 0, [], []
        for size in pdf["length"]:
            if filled + size > CAPACITY:
                bins, filled = bins + 1, 0
            seq.append(bins)
            off.append(filled)
            filled += size
        return pdf.assign(sequence_id=seq, offset=off)[columns]

    # fewer than j pieces of each class j, so fewer than CAPACITY x classes rows, whatever the corpus
    rest = placed.where(F.col("bin") >= lookup(full)).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(next_fit, whole.schema)
    return whole.unionByName(rest)


def op4_harmonic_packing(spark, sf_dir) -> DataFrame:
    return pack(C.table(spark, sf_dir, "documents"), default_tokenizer())


def stage_pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed; no document goes, and an empty table gives no rows."""
    C.bounded_batches(spark)
    return pack(docs, default_tokenizer())
