import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from weatherloom.llm import interpolation
from weatherloom.llm.interpolation import fit_weights, score_texts


def tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def fold(i):
    return 0 if i is None else zlib.crc32(str(i).encode()) % 10


def by_force(rows):
    """Counts of a corpus that fits in memory, and base scores."""
    words, pairs, fit = Counter(), Counter(), Counter()
    for i, text in rows:
        if fold(i):
            row = tokens(text)
            words.update(row)
            pairs.update(zip(["\n", *row], row))
            if fold(i) != 1:
                fit.update(row)
    return words, pairs, fit


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_counts_and_base_scores(which, request):
    frame = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    words, _, _ = by_force(rows)
    n, v = sum(words.values()), len(words)
    want = sorted(
        (
            str(i), fold(i) == 0, len(tokens(t)), sum(w in words for w in tokens(t)), n,
            round(sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6),
        )
        for i, t in rows
    )
    got = score_texts(frame, block_bytes=20_000).collect()
    assert want == sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    )
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


@pytest.mark.parametrize("order", [2, 3])
def test_scores_are_the_mixture(documents, monkeypatch, order):
    """Block-wise scores equal those of the plain counts under the same weights."""
    kept = []

    def remember(bucket, estimates, n, **more):
        kept.append(fit_weights(bucket, estimates, n, **more))
        return kept[-1]

    monkeypatch.setattr(interpolation, "fit_weights", remember)
    got = {r.doc_id: r for r in score_texts(documents, block_bytes=30_000, order=order).collect()}
    assert len(kept) == order - 1
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    words, pairs, _ = by_force(rows)
    triples = Counter()
    for i, text in rows:
        if fold(i):
            row = ["\n", *tokens(text)]
            triples.update(zip(row, row[1:], row[2:]))
    n, v = sum(words.values()), len(words)
    bucket = lambda c: min(c.bit_length(), interpolation.BUCKETS - 1)
    higher = 0
    for row in documents.limit(60).collect():
        total, first, before = 0.0, None, "\n"
        for w in tokens(row.text):
            c = words[before]
            share = kept[0][bucket(c)]
            p = share[0] * pairs[before, w] / max(c, 1) + share[1] * words[w] / n + share[2] / (v + 1)
            c = pairs[first, before] if first is not None else 0
            if order == 3 and c:
                share = kept[1][bucket(c)]
                higher += triples[first, before, w] > 0
                p = share[0] * triples[first, before, w] / c + share[1] * p
            total, first, before = total + math.log10(p), before, w
        assert got[row.doc_id].score == pytest.approx(total)
    assert (higher > 0) == (order == 3)


def test_held_out_text_is_scored_better_than_by_the_base(documents):
    held = score_texts(documents).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held.s > held.b


def test_weights_find_a_known_mixture():
    rng = np.random.default_rng(1)
    estimates = rng.dirichlet([0.3] * 3, 4000)
    true = np.array([0.6, 0.3, 0.1])
    n = rng.poisson(4000 * (estimates @ true)).astype(float)
    found = fit_weights(np.full(4000, 3), estimates, n, rounds=400)
    assert found.sum(axis=1) == pytest.approx(1) and (found > 0).all()
    likelihood = lambda w: (n * np.log(estimates @ w)).sum()
    assert likelihood(found[3]) >= likelihood(true) - 5


def test_trigrams_help(spark):
    """Held-out texts of the larger table are likelier with trigrams than without."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    two, three = (score_texts(documents, order=k).where("held_out").selectExpr("sum(score)").first()[0] for k in (2, 3))
    assert three > two


def test_empty_and_nothing_to_learn(empty, odd):
    assert score_texts(empty).count() == 0
    alone = score_texts(odd.where("doc_id is null")).collect()
    assert alone and all(r.held_out and r.train_tokens == 0 and math.isfinite(r.score) for r in alone)
