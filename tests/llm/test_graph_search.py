import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import graph_search
from weatherloom.llm.graph_search import beam_search, build_graph, nearest, prune, with_equal_norms

from .conftest import FOLDER


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def exact(rows, count=20):
    """query -> [(score, id)] over all other ids, best first, ties to smaller ids."""
    rows = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and usable(v)]
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            found = [(-round(float(v @ w), 12), j) for j, w in rows if j != i and len(w) == len(v)]
            out[i] = [(-s, j) for s, j in sorted(found)[:count]]
    return out


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding")


@pytest.mark.parametrize("shard", [100, 4096])
def test_recall(embeddings, shard):
    want = exact([(r.vec_id, r.embedding) for r in embeddings.collect()])
    got = nearest(embeddings, F.col("vec_id") % 20 == 0, shard=shard).collect()
    assert {r.query_id for r in got} == want.keys()
    hits = 0
    for q, best in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-round(r.score, 12), r.vec_id) for r in mine] == sorted((-round(r.score, 12), r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & {j for _, j in best})
    assert hits >= 0.95 * 20 * len(want)


def test_copies_and_unusable_vectors(spark):
    one = [1.0, 0.5, 0.0]
    rows = [(20 * i, one) for i in range(60)]
    rows += [(1, [0.9, 0.4, 0.1]), (2, None), (40 * 100, []), (5, [0.0] * 3), (6, [float("nan")] * 3)]
    rows += [(7, [None, 1.0, 1.0]), (None, one), (8, [float("inf"), 0.0, 0.0]), (20000, [1.0, 2.0]), (20001, [-3.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    got = {}
    for r in nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(rows)
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [v for _, v, _ in sorted(got[q])] == [j for _, j in best]
        assert [s for *_, s in sorted(got[q])] == pytest.approx([s for s, _ in best])
    assert [v for _, v, _ in sorted(got[20000])] == [20001]
    assert nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pruned_edges_point_in_different_directions():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [5, 5]], dtype=np.float32)
    kept = prune(x, np.array([0]), np.array([[1, 2, 3, 4, 1, -1]]), 4, 1.2)[0]
    assert kept.tolist() == [1, 3, -1, -1] or kept.tolist()[:2] == [1, 3]
    assert 2 not in kept


def test_small_graphs():
    for n in (1, 2, 5, 70):
        x = np.random.default_rng(n).normal(size=(n, 4))
        graph, entry = build_graph(with_equal_norms(x, 10.0))
        ids, _ = beam_search(x.astype(np.float32), graph, entry, x.astype(np.float32), 96, inner=True)
        assert (np.sort(ids[:, : n], axis=1)[:, -n:] == np.arange(n)).all()


@pytest.mark.parametrize("spread", [0.05, 0.3])
def test_full_shard_of_hot_groups(spread):
    """20 groups of 200 near copies: no query may end in another group."""
    rng = np.random.default_rng(3)
    x = np.concatenate([c + spread * rng.normal(size=(200, 64)) for c in rng.normal(size=(20, 64))])
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    graph, entries = build_graph(with_equal_norms(x.astype(np.float64), 1.0))
    asks = np.arange(0, len(x), 10)
    ids, _ = beam_search(x, graph, entries, x[asks], 96, inner=True)
    want = np.argsort(-(x[asks] @ x.T), axis=1)[:, :20]
    hits = [len(set(a[:20]) & set(b)) for a, b in zip(ids.tolist(), want.tolist())]
    assert min(hits) > 0 and np.mean(hits) >= 0.99 * 20


def test_every_point_can_be_reached():
    """A ring of edges that lead nowhere else is joined by edges of its own."""
    x = np.arange(12, dtype=np.float32)[:, None]
    graph = np.array([[(i + 1) % 4 + i // 4 * 4] for i in range(12)], dtype=np.int32)
    whole = graph_search._reachable(x, graph, np.array([0]))
    reached = np.zeros(12, dtype=bool)
    graph_search._spread_from(whole, np.array([0]), reached)
    assert reached.all() and (whole[:, :1] == graph).all()


def test_ids_that_repeat(spark):
    """An id of many rows hides no other one: twenty-five rows of id 20 equal those of 41 to 59."""
    one = [1.0, 2.0, 0.0]
    rows = [(20, one)] * 25 + [(i, one) for i in range(41, 60)] + [(40, [2.0, 1.0, 0.5])] * 2
    rows += [(100 + i, [0.1, 0.1, 0.1 * i]) for i in range(1, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    # of nineteen equal vectors and the next best, for each of the rows that ask
    assert sorted(got[20]) == sorted([*((k + 1, 41 + k) for k in range(19)), (20, 40)] * 25)
    # each of the twenty-five rows is a candidate, and the smallest id goes first
    assert sorted(got[40]) == sorted([(k + 1, 20) for k in range(20)] * 2)
