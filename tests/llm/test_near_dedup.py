from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from weatherloom.llm import alike
from weatherloom.llm.components import connected_components
from weatherloom.llm.near_dedup import drop_near_duplicates, minhash, near_duplicates


def shingles(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in text).split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def by_force(rows, percent=85):
    """(id, set size, component id) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for held in holders.values() for k, b in enumerate(held) for a in held[:k])
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    ids = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        if name is not None:
            ids[root(i)].append(name)
    return [(name, len(sets[i]), min(ids[root(i)], default=None)) for i, (name, _) in enumerate(rows)]


def planted():
    base = [f"w{i}" for i in range(60)]
    star = [" ".join(base + [f"q{i}", f"r{i}"]) for i in range(20)]
    chain = [" ".join(f"c{j}" for j in range(i * 3, i * 3 + 70)) for i in range(30)]
    half = [" ".join(base[:30] + [f"h{i}_{j}" for j in range(30)]) for i in range(20)]
    return list(enumerate(star + chain + half, start=1000))


@pytest.mark.parametrize("which", ["planted", "table", "odd"])
def test_equals_brute_force(spark, documents, odd, which):
    frame = {"table": documents, "odd": odd}.get(which)
    if frame is None:
        frame = spark.createDataFrame(planted(), "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    got = near_duplicates(frame).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(by_force(rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.component_id is not None)
    alone = [r for r in got if r.n_shingles == 0]
    assert all(r.kept and r.first for r in alone)
    groups = Counter(r.component_id for r in got if r.n_shingles and r.first and r.component_id is not None)
    assert set(groups.values()) <= {1}


def test_alike_members_of_a_large_family(spark):
    """All share buckets; only six, never a smallest node, are alike (126 / 142), others at most 126 / 159."""
    base = [f"w{i}" for i in range(130)]
    own = {i: 8 if i % 350 == 349 else 25 for i in range(2_100)}
    rows = [(i, " ".join(base + [f"o{i}_{j}" for j in range(n)])) for i, n in own.items()]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 349 if n == 8 else i for i, n in own.items()}


def test_blocks_of_members_meet(spark, monkeypatch):
    """Every pair of a bucket with different roots is in one tile; equal sketches reject none."""
    monkeypatch.setattr(alike, "TILE", 3)
    rows = [(7, i, i % 15, 20, 30, bytes(8)) for i in range(30)]
    rest = spark.createDataFrame(rows, "bucket long, node long, root long, n long, members long, sketch binary")
    got = {(r.a, r.b) for r in alike._tiled(rest, 85).collect()}
    assert got == {(b, a) for a in range(30) for b in range(a) if a % 15 != b % 15}


def test_one_of_each_group_stays(odd):
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("x") == 1 and sum((t or "").lower().split() == ["same", "words", "here"] for t in texts) == 1


def test_empty(empty):
    assert near_duplicates(empty).count() == 0
    assert drop_near_duplicates(empty).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
    a, b = pool[:300], pool[30:330]
    doc = np.repeat([0, 1, 2, 3], [300, 300, 3, 3])
    lines = minhash(doc, np.concatenate([a, b, a[:3], a[:3]]), 4, 2000)
    assert abs((lines[0] == lines[1]).mean() - 270 / 330) < 0.1
    assert (lines[2] == lines[3]).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert len({got[i] for i in range(201)}) == 1 and got[500] == got[501] != got[0]
    assert connected_components(edges.limit(0)).count() == 0


def test_long_arrow_strings():
    from weatherloom.llm.tokens import Words

    texts = pa.array(["a b", None, "c"], pa.large_string()).slice(1, 2)
    assert Words(texts, lower=False).counts.tolist() == [0, 1]
