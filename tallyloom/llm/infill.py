"""Fill-in-middle transformation: texts are cut into prefix, middle and suffix at two units and put in another order.

A unit is a word with the white space before it, or white space at a text's end. While a text's units are counted, a
sparse index of checkpoints is kept: every STEP units, the bytes and the code points up to there. To find a cut, the
last checkpoint before it is looked up by binary search, and only what lies between it and the cut is scanned again.
The count runs over CHUNK bytes at a time, so what it holds is a small multiple of CHUNK and the checkpoints.

Whether a text is changed, how, and where it is cut follow from a hash of its doc_id alone, so any executor can make a
row again. A text that holds a marker stays as it is, so every output can be undone (`restored`).

Defined results: a null text counts as empty, and stays plain; a null doc_id is hashed as no digits; rows that repeat
get equal results; an empty table gives no rows; a very long text is handled whole; other columns aren't read, whatever
their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Units from one checkpoint to the next, and bytes that are counted at once.
STEP, CHUNK = 64, 1 << 16
#: Of a hundred texts, how many are changed, and of a hundred changed ones, how many put the suffix first.
RATE, SUFFIX_FIRST = 50, 80
SEED = 42
MARKS = ("<P>", "<S>", "<M>")
UNIT = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")

_UNITS = r"regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"
_H = "('0x' || substr(sha256('42:' || doc_id), {}, 8))::BIGINT"
ORACLE = f"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, {_UNITS} AS u, {", ".join(f"{_H.format(8 * i + 1)} AS h{i + 1}" for i in range(4))} FROM documents),
c AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM u),
p AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""


class Checkpoints:
    """The units of a text, counted, with a sparse index of where they end."""

    def __init__(self, text: np.ndarray, step: int = STEP, chunk: int = CHUNK):
        """text: its bytes."""
        self.text, self.step = text, step
        units, chars = 0, 0
        bytes_at, chars_at = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        for lo in range(0, len(text), chunk):
            part = text[lo : lo + chunk]
            word = C.NOT_SPACE[part]
            ends = word.copy()  # a unit ends with the last byte of a word, or with the text
            ends[:-1] &= ~word[1:]
            if lo + chunk < len(text):
                ends[-1] &= not C.NOT_SPACE[text[lo + chunk]]
            else:
                ends[-1] = True
            at = np.flatnonzero(ends)
            marked = at[step - 1 - units % step :: step]
            lead = np.cumsum((part & 0xC0) != 0x80)
            bytes_at.append(lo + marked + 1)
            chars_at.append(chars + lead[marked])
            units, chars = units + len(at), chars + int(lead[-1])
        self.units, self.chars = units, chars
        self.bytes_at, self.chars_at = np.concatenate(bytes_at), np.concatenate(chars_at)
        self.units_at = np.arange(len(self.bytes_at)) * step

    def cut(self, unit: int) -> tuple[int, int]:
        """Bytes and code points of the first units."""
        k = int(np.searchsorted(self.units_at, unit, side="right")) - 1
        start, chars = int(self.bytes_at[k]), int(self.chars_at[k])
        end = start
        stop = int(self.bytes_at[k + 1]) if k + 1 < len(self.bytes_at) else len(self.text)
        near = self.text[start:stop].tobytes()
        for _, match in zip(range(unit - int(self.units_at[k])), UNIT.finditer(near), strict=False):
            end = start + match.end()
        piece = self.text[start:end]
        return end, chars + int(np.count_nonzero((piece & 0xC0) != 0x80))


def plan(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """doc_id, text, form, h1, h2 of every row."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    text = F.coalesce(F.col("text"), F.lit(""))
    held = text.contains(MARKS[0]) | text.contains(MARKS[1]) | text.contains(MARKS[2])
    plain = (text == "") | held | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    return docs.select("doc_id", text.alias("text"), form.alias("form"), h[0].alias("h1"), h[1].alias("h2"))


def transformed(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain), output, for every row of docs (doc_id, text)."""
    rows = plan(docs, rate, suffix_first, seed)
    p, s, m = (x.encode() for x in MARKS)

    def change(batches):
        for batch in batches:
            for part in C.slices(batch):
                data, offs = C.utf8(part.column("text"))
                found: list[tuple] = []
                for i, (form, h1, h2) in enumerate(zip(*(part.column(c).to_pylist() for c in ("form", "h1", "h2")), strict=True)):
                    text = data[offs[i] : offs[i + 1]]
                    index = Checkpoints(text)
                    if form == "plain":
                        found.append((index.units, None, None, text.tobytes()))
                        continue
                    (a, a_chars), (b, b_chars) = (index.cut(x) for x in sorted((h1 % (index.units + 1), h2 % (index.units + 1))))
                    prefix, middle, suffix = text[:a].tobytes(), text[a:b].tobytes(), text[b:].tobytes()
                    out = (p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle)
                    found.append((index.units, a_chars, b_chars - a_chars, b"".join(out)))
                n, before, between, output = zip(*found, strict=True)
                columns = [part.column("doc_id"), pa.array(n, pa.int64()), part.column("form"), pa.array(before, pa.int64()), pa.array(between, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(C.released(change), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, "|".join(MARKS))
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def op13_fill_in_middle(spark, sf_dir) -> DataFrame:
    rows = transformed(C.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
