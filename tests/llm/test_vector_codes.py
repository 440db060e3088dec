import math

import numpy as np
import pytest

from weatherloom.llm.vector_codes import Bounds, decoded, displacements, fit_codes, label_errors, pack, unpack

SCHEMA = "vec_id long, embedding array<double>, label string, id string, x string, near string, totals string"


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(codebooks, [(id, label, codes, error)]) by measuring every distance in every round."""
    kept = []
    for name, vector, label in rows:
        if vector and all(c is not None and math.isfinite(c) for c in vector):
            kept.append((name, [math.floor(4096 * c) for c in vector], label))
    named = {}
    for name, vector, _ in kept:
        if name is not None:
            named.setdefault(name, vector)
    if not named:
        return [], []
    size = len(named[min(named)])
    kept = [k for k in kept if len(k[1]) == size]
    width = size // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[named[i][p * width : (p + 1) * width] for i in sorted(named)[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            groups = [[] for _ in books[p]]
            for x in cut:
                groups[near(p, x[p])[1]].append(x[p])
            fresh.append([
                [sum(c) // len(g) for c in zip(*g, strict=True)] if g else books[p][e] for e, g in enumerate(groups)
            ])
        books = fresh
    out = []
    for (name, _, label), x in zip(kept, cut, strict=True):
        found = [near(p, x[p]) for p in range(parts)]
        out.append((name, label, bytes(e for _, e in found), sum(d for d, _ in found)))
    return books, out


def vectors(n, width=16, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(7, width)) * spread
    return (middles[rng.integers(0, 7, n)] + 0.2 * rng.normal(size=(n, width))).tolist()


def frame_of(spark, rows, parts=4):
    return spark.createDataFrame([(*row, "other", "other", "other", "other") for row in rows], SCHEMA).repartition(parts)


def compare(spark, rows):
    books, want = plain_codes(rows)
    fitted = fit_codes(frame_of(spark, rows))
    assert fitted.codebooks.tolist() == books or not books
    got = [(r.id, r.label, bytes(r.codes), r.error) for r in fitted.codes.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return fitted, want


def test_equals_plain_rounds(spark):
    rows = [(i, v, f"l{i % 3}") for i, v in enumerate(vectors(900))]
    fitted, want = compare(spark, rows)
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert all(r.label_error == sums[r.label] for r in label_errors(fitted.codes).collect())
    back = {r.id: r.vector for r in decoded(fitted.codes, fitted.codebooks).collect()}
    errors = {name: error / 4096**2 for name, _, _, error in want}
    assert all(abs(np.square(np.subtract(back[i], v)).sum() - errors[i]) < 0.01 for i, v, _ in rows)


def test_odd_rows(spark):
    good = vectors(60, seed=1)
    rows = [(i, v, None if i % 4 == 0 else "a") for i, v in enumerate(good)]
    rows += [(100, None, "a"), (101, [], "a"), (102, [None] * 16, "b"), (103, [math.nan] * 16, None)]
    rows += [(104, [math.inf] + [0.0] * 15, None), (105, [1.0] * 8, "a"), (106, [0.0] * 16, None), (106, [0.0] * 16, None)]
    rows += [(None, good[0], "a"), (None, good[0], "a"), (107, good[5], "b"), (7, good[7], "z"), (None, None, None)]
    fitted, want = compare(spark, rows)
    nothing = sum(error for _, label, _, error in want if label is None)
    assert {r.label_error for r in label_errors(fitted.codes).where("label is null").collect()} == {nothing}


def test_ties_and_equal_vectors(spark):
    compare(spark, [(i, [0.5 * (i % 2)] * 16, "a") for i in range(50)])
    compare(spark, [(i, [1.0 / 4096 * ((i * k) % 5 - 2) for k in range(16)], "a") for i in range(200)])
    compare(spark, [(3, [0.25] * 16, None)])


def test_lengths(spark):
    """Too large numbers and other lengths are left out; a remainder is filled up."""
    rows = [(1, [0.5] * 10, "a"), (2, [0.25] * 10, "a"), (3, [1e6] + [0.0] * 9, "a"), (4, [0.5] * 16, "a")]
    fitted = fit_codes(frame_of(spark, rows))
    assert sorted((r.id, r.error) for r in fitted.codes.collect()) == [(1, 0), (2, 0)]
    assert fitted.codebooks.shape == (8, 2, 2)


@pytest.mark.parametrize("rows", [[], [(None, [0.5] * 16, "a")], [(1, None, "a")]])
def test_nothing_to_fit(spark, rows):
    fitted = fit_codes(frame_of(spark, rows))
    assert label_errors(fitted.codes).count() == 0 and fitted.codebooks.size == 0


def test_bounds_settle_most_distances():
    """Exact in every round, with far fewer distances than all of them; net moves, not their sum."""
    rng = np.random.default_rng(2)
    x = np.floor(4096 * np.array(vectors(4000, seed=2))).astype(np.int64).reshape(-1, 8, 2)
    history = [x[:16].transpose(1, 0, 2).copy()]
    bounds = Bounds(x, None, 16)
    measured = []
    for k in range(9):
        before = bounds.measured
        bounds.advance(history, displacements(history))
        measured.append(bounds.measured - before)
        squares = np.square(x[:, :, None] - history[-1][None]).sum(axis=3)
        assert (bounds.near == squares.argmin(axis=2)).all()
        # a codebook that swings back makes old bounds whole again
        swing = history[0] if k % 2 else history[0] + rng.integers(-60, 60, history[0].shape)
        history.append(swing)
    assert measured[0] == x.shape[0] * 8 * 16 and max(measured[1:]) < measured[0] / 4
    assert (displacements([history[0], history[1], history[0]])[0] == 0).all()


def test_packed_columns():
    matrix = np.arange(24, dtype=np.float16).reshape(4, 2, 3)
    assert (unpack(pack(matrix).slice(1, 2), np.float16, 2, 3) == matrix[1:3]).all()
    assert len(unpack(pack(matrix[:0]), np.float16, 2, 3)) == 0
