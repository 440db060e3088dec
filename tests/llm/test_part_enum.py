from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from weatherloom.llm import alike, part_enum
from weatherloom.llm.alike import Sets, differing, folded, groups, sketches
from weatherloom.llm.part_enum import alike_components, bands_to, signatures

from .test_near_dedup import by_force


def sets_from(*values):
    size = np.array([len(v) for v in values], dtype=np.int64)
    keys = np.arange(len(values))
    return Sets(np.concatenate(values), np.concatenate([[0], np.cumsum(size)]), size, keys, keys)


def drawn_pairs(rng, count, percent):
    """Pairs of sets just alike: any less in common would be too little."""
    while count:
        a = int(rng.integers(1, 300))
        b = int(rng.integers(a, a * 100 // percent + 1))
        common = -(-percent * (a + b) // (100 + percent))
        if common <= a and (a, b) != (common, common):
            pool = rng.integers(0, 2**63, a + b - common, dtype=np.uint64)
            yield sets_from(np.sort(pool[:a]), np.sort(pool[a - common :]))
            count -= 1


@pytest.mark.parametrize("percent", [76, 80, 90])
def test_alike_sets_share_a_signature(percent):
    for sets in drawn_pairs(np.random.default_rng(percent), 1500, percent):
        text, band, signature = signatures(sets, percent)
        found = [set(zip(band[text == i], signature[text == i], strict=True)) for i in (0, 1)]
        assert found[0] & found[1]


def test_empty_cells_make_no_signatures():
    """Unrelated sets share none, and sets that are unsure sign by further cuts of the domain."""
    rng = np.random.default_rng(0)
    sets = sets_from(*(rng.integers(0, 2**63, n, dtype=np.uint64) for n in [4, 5, 9, 30, 200] * 200))
    text, _, signature = signatures(sets)
    assert max(Counter(signature.tolist()).values()) == 1
    per_text = np.bincount(text, minlength=1000).reshape(200, 5)
    assert (per_text > 0).all() and (per_text[:, 4] > per_text[:, 4].min()).any()


def test_bands_cover_all_sizes():
    bands = bands_to(5000, 80)
    assert [b.low for b in bands[1:]] == [b.high + 1 for b in bands[:-1]] and bands[-2].high >= 5000
    with pytest.raises(ValueError):
        bands_to(10, 50)


def test_sketches_never_reject():
    rng = np.random.default_rng(1)
    for sets in drawn_pairs(rng, 300, 80):
        a, b = sketches(sets, 80)
        a, b = folded(a, len(b)), folded(b, len(a))
        assert np.bitwise_count(a ^ b).sum() <= differing(sets.size.sum(), 80)


def planted():
    base = [f"w{i}" for i in range(60)]
    star = [" ".join(base + [f"q{i}", f"r{i}"]) for i in range(20)]
    chain = [" ".join(f"c{j}" for j in range(i * 3, i * 3 + 70)) for i in range(30)]
    half = [" ".join(base[:30] + [f"h{i}_{j}" for j in range(30)]) for i in range(20)]
    short = [" ".join(f"s{j}" for j in range(i, i + 9)) for i in range(6)] + ["a b c d e f g h", "a b c d e f g h i"]
    return list(enumerate(star + chain + half + short, start=1000))


@pytest.mark.parametrize("which", ["planted", "table", "odd"])
def test_equals_brute_force(spark, documents, odd, which):
    frame = {"table": documents, "odd": odd}.get(which)
    if frame is None:
        frame = spark.createDataFrame(planted(), "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    got = [tuple(r) for r in alike_components(frame).collect()]
    assert sorted(got, key=str) == sorted(by_force(rows, 80), key=str)


def family(n):
    """All share signatures; of every hundred texts two are alike, the others are not."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        own = i if i % 100 != 99 else i - 1  # 98 and 99 differ in their last words only
        extra = [f"o{own}_{j}" for j in range(24)] + ([f"z{j}" for j in range(2)] if i % 100 == 99 else [])
        rows.append((i, " ".join(base + extra)))
    return rows


def test_alike_members_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(alike, "TILE", 64)
    rows = family(600)
    got = alike_components(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(by_force(rows, 80))
    assert sum(r.doc_id != r.component_id for r in got) == 6


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    """Beyond the sizes that are broadcast."""
    monkeypatch.setattr(alike, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(part_enum, "OWNER_ROW_BYTES", 1 << 40)
    monkeypatch.setattr(part_enum, "FILTER_BITS", 64)  # lets almost every signature pass
    monkeypatch.setattr(part_enum, "REMEMBERED", 1)
    rows = planted() + [(5, planted()[0][1]), (6, planted()[0][1]), (7, None), (None, "a b c d e f g h")]
    got = alike_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(by_force(rows, 80), key=str)


def test_filter_lets_all_of_its_signatures_pass(spark):
    rng = np.random.default_rng(5)
    inside, outside = rng.integers(0, 1 << 64, (2, 5_000), dtype=np.uint64)
    shared = spark.createDataFrame([(int(v),) for v in inside.view(np.int64)], "sig long")
    for most, others in ((1 << 27, 0.03), (1 << 12, 1.0)):
        words = part_enum.signature_filter(shared, most)
        assert 64 * len(words) <= most and part_enum.passes(words, inside).all()
        assert part_enum.passes(words, outside).mean() <= others
    none = part_enum.signature_filter(shared.limit(0), 1 << 27)
    assert not part_enum.passes(none, outside).any()


def test_empty(empty):
    assert alike_components(empty).count() == 0


def test_groups_over_batches():
    def batch(keys):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], names=["k"])

    got = groups(iter([batch([1, 1]), batch([]), batch([1, 2, 3]), batch([3])]), ["k"])
    assert [t.column("k").to_pylist() for t in got] == [[1, 1, 1], [2], [3, 3]]
