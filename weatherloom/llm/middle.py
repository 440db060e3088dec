"""Fill-in-the-middle examples: a text's units are cut in three and put in another order.

A unit is a line with its end. Eight bytes of UTF-8 are one 64-bit word: arithmetic
on whole words marks the bytes that end a unit, counts of marked bits by word are
summed up, the k-th mark is searched in the sums, and its byte is found inside the
word, again by arithmetic on all eight bytes at once. No text is decoded or scanned
byte by byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.llm.shipping import map_arrow
from weatherloom.llm.tokens import slices, text_bytes

SEED = 7
# shares in percent: texts that are cut at all, and of these the suffix-first ones
RATE = 100
SUFFIX_FIRST = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT_END = "\n"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)


def as_words(raw: np.ndarray) -> np.ndarray:
    """Bytes as 64-bit words, the first byte lowest, filled up with zeros."""
    padded = np.zeros(-(-len(raw) // 8) * 8, dtype=np.uint8)
    padded[: len(raw)] = raw
    return padded.view("<u8")


def equal_bytes(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of every byte that equals ``byte``; no carry leaves its byte."""
    x = words ^ (_ONES * np.uint64(byte))
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def inner_bytes(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that continues a code point (10xxxxxx)."""
    return words & ~(words << np.uint64(1)) & _HIGH


class Marks:
    """Rank and select over marked bytes (high bits in words)."""

    def __init__(self, marks: np.ndarray):
        self.marks = np.append(marks, np.uint64(0))
        self.before = np.zeros(len(self.marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before byte ``at``."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        part = self.marks[word] & ((np.uint64(1) << bits) - np.uint64(1))
        return self.before[word] + np.bitwise_count(part)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the ``k``-th marked byte, from 1."""
        word = np.searchsorted(self.before, k, "left") - 1
        left = (k - self.before[word]).astype(np.uint64)
        # byte i of the product: marks in bytes 0 to i
        running = (self.marks[word] >> np.uint64(7)) * _ONES
        reached = ((running | _HIGH) - left * _ONES) & _HIGH
        return word * 8 + 8 - np.bitwise_count(reached)


def cut_units(texts: pa.Array, one: np.ndarray, two: np.ndarray, unit_end: str = UNIT_END):
    """Units of each text and where its prefix and middle end, in bytes and code points.

    ``one`` and ``two`` are drawn numbers; the prefix has the smaller of their
    remainders modulo units + 1, prefix and middle together the larger.
    """
    raw, bounds = text_bytes(texts)
    words = as_words(raw)
    marks = equal_bytes(words, ord(unit_end))
    begin, end = bounds[:-1], bounds[1:]
    last = end[end > begin] - 1  # a text ends its last unit
    np.bitwise_or.at(marks, last >> 3, np.uint64(0x80) << ((last & 7) << 3).astype(np.uint64))
    ends, inner = Marks(marks), Marks(inner_bytes(words))
    before = ends.rank(begin)
    n = ends.rank(end) - before
    one, two = one % (n + 1), two % (n + 1)

    def place(k):
        at = begin.copy()
        some = k > 0
        at[some] = ends.select(before[some] + k[some]) + 1
        return at

    first, second = place(np.minimum(one, two)), place(np.maximum(one, two))

    def chars(a, b):
        return (b - a) - (inner.rank(b) - inner.rank(a))

    return raw, bounds, n, first, second, chars(begin, first), chars(first, second)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
    unit_end: str = UNIT_END,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for each row, in one stage.

    ``n`` is the number of units, which end with the ASCII character ``unit_end`` or
    the text. The four drawn numbers are the first four 32-bit groups of the SHA-256
    of "seed:id", so a rerun cuts alike. Form is plain if the text is empty, contains
    one of the ``marks``, or is not among the ``rate`` percent that are cut; else spm
    (suffix first) for ``suffix_first`` percent and psm for the others:
    ``<P>prefix<S>suffix<M>middle`` and ``<S>suffix<P>prefix<M>middle``.
    ``restored`` gives the text back.

    A null text is an empty one: plain, no units, empty output. A null id draws as an
    empty id. Counts of a plain row are null but for ``n``. Repeated rows come out
    as often as they went in, all alike; other columns are not looked at.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    draw = [F.conv(F.substring(F.sha2(key, 256), 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = (text == "") | (draw[2] % 100 >= rate)
    for mark in marks:
        plain = plain | F.contains(text, F.lit(mark))
    form = F.when(plain, "plain").when(draw[3] % 100 < suffix_first, "spm").otherwise("psm")
    source = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), form.alias("form"), draw[0].alias("one"), draw[1].alias("two")
    )
    schema = StructType([source.schema["id"]])
    for name in ("n long", "form string", "prefix_chars long", "middle_chars long", "output string"):
        schema.add(*name.split())
    p, s, m = (mark.encode() for mark in marks)

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                one, two = (part.column(c).to_numpy() for c in ("one", "two"))
                raw, bounds, n, first, second, before, between = cut_units(part.column("text"), one, two, unit_end)
                whole, forms, output = memoryview(raw), part.column("form").to_pylist(), []
                for a, b, c, d, kind in zip(
                    bounds[:-1].tolist(), first.tolist(), second.tolist(), bounds[1:].tolist(), forms, strict=True
                ):
                    if kind == "plain":
                        output.append(bytes(whole[a:d]))
                    elif kind == "spm":
                        output.append(b"".join((s, whole[c:d], p, whole[a:b], m, whole[b:c])))
                    else:
                        output.append(b"".join((p, whole[a:b], s, whole[c:d], m, whole[b:c])))
                uncut = np.array([kind == "plain" for kind in forms], dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(n),
                        part.column("form"),
                        pa.array(before, mask=uncut),
                        pa.array(between, mask=uncut),
                        pa.array(output, pa.binary()).cast(pa.string()),
                    ],
                    names=schema.names,
                )

    return map_arrow(source, rearrange, schema).withColumnRenamed("id", id_col)


def restored(
    output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)
) -> Column:
    """The text that ``output`` was made from.

    A cut text has none of the marks, so each of them occurs once.
    """
    parts = F.split(output, "|".join(re.escape(mark) for mark in marks), -1)
    psm = F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))
    spm = F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def _cut(which: str) -> str:
    return f"CASE WHEN form = 'plain' THEN NULL ELSE length({which}) END"


ORACLE = rf"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n,
         CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (len(u) + 1) AS h1,
         CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (len(u) + 1) AS h2,
         CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 AS h3,
         CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 AS h4
  FROM units
), cut AS (
  SELECT *,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}')
                   OR contains(text, '{MIDDLE}') OR h3 >= {RATE} THEN 'plain'
              WHEN h4 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(u[1:least(h1, h2)], ''), '') AS prefix,
         coalesce(array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], ''), '') AS middle,
         coalesce(array_to_string(u[greatest(h1, h2) + 1:], ''), '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST({_cut('prefix')} AS BIGINT) AS prefix_chars,
       CAST({_cut('middle')} AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
