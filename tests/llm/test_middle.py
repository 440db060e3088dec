import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weatherloom.llm.middle import Marks, as_words, equal_bytes, fill_in_middle, inner_bytes, restored


def by_force(name, text, seed=7, rate=100, first=50):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(frame, **options):
    got = fill_in_middle(frame, **options).withColumn("text", restored(F.col("output"), F.col("form")))
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"rate": 40, "first": 10, "seed": 3}])
def test_equals_plain_python(spark, documents, odd, empty, options):
    texts = ["a\nb\n\nc", "\n", "\n\n\n", "x<P>\ny", "<S\n>", "<\nP>", "é\n日本\n👩‍👩‍👧", "\r\n" * 9, "<S", "a\0\nb"]
    marked = spark.createDataFrame(list(enumerate(texts * 20)), "doc_id long, text string")
    given = {"suffix_first" if k == "first" else k: v for k, v in options.items()}
    for frame in (documents, odd, marked, empty):
        want = [(r.doc_id, *by_force(r.doc_id, r.text, **options), r.text or "") for r in frame.collect()]
        assert rows_of(frame, **given) == sorted(want, key=str)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=200))
def test_rank_and_select_in_words(raw):
    array = np.frombuffer(raw, np.uint8)
    words = as_words(array)
    for marks, held in (
        (equal_bytes(words, 10), array == 10),
        (inner_bytes(words), (array & 0xC0) == 0x80),
    ):
        found = Marks(marks)
        at = np.arange(len(array) + 1)
        assert found.rank(at).tolist() == np.concatenate([[0], np.cumsum(held)]).tolist()
        places = np.flatnonzero(held)
        assert found.select(np.arange(1, len(places) + 1)).tolist() == places.tolist()


def test_slices_of_arrow_strings():
    from weatherloom.llm.middle import cut_units

    texts = pa.array(["skipped\n", "a\nbc", "", "é\n"]).slice(1)
    raw, bounds, n, first, second, before, between = cut_units(texts, np.array([0, 0, 1]), np.array([1, 5, 1]))
    assert n.tolist() == [2, 0, 1]
    assert [bytes(raw[a:b]) for a, b in zip(bounds[:-1], first, strict=True)] == [b"", b"", "é\n".encode()]
    assert before.tolist() == [0, 0, 2] and between.tolist() == [2, 0, 0]
