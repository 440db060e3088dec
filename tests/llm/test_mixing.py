import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import catalog, mixing

from .conftest import FOLDER


def targets_of(sizes, weights, repeats):
    """Share by weight; what is over a limit goes to the others, again and again."""
    target = dict.fromkeys(sizes, 0.0)
    rest, open_ = float(sum(sizes.values())), set(sizes)
    while open_ and rest > 1e-9:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if rest * weights[s] / total > repeats * sizes[s]}
        if not over:
            for s in open_:
                target[s] = rest * weights[s] / total
            break
        for s in over:
            target[s] = float(repeats * sizes[s])
            rest -= target[s]
        open_ -= over
    return target


def test_equals_sql_on_the_table(spark):
    got = catalog.op1_source_mixing(spark, FOLDER).toPandas().sort_values("doc_id", ignore_index=True)
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
        want = db.sql(mixing.ORACLE).df().sort_values("doc_id", ignore_index=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


@pytest.mark.parametrize("sizes", [[5, 100, 100], [0, 7, 1, 90], [1], [0, 0], [3, 3, 3, 3, 200]])
def test_targets(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    frame = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame, (1, 2, 3), 3).collect()}
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    want = targets_of(dict(zip(names, sizes)), weights, 3)
    assert got == pytest.approx(want)


def test_mix_of_odd_rows(odd):
    got = mixing.mix_sources(odd).toPandas()
    source = odd.select("doc_id", "text", "source").toPandas()
    assert len(got) == len(source)
    words = source.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    assert sorted(got["size"]) == sorted(words)
    assert (got.taken <= 3 * got["size"]).all() and (got.taken >= 0).all()
    by_source = got.groupby(["source_size", "target"]).taken.sum()
    for (_, target), taken in by_source.items():
        assert abs(target - taken) < 1
    assert got.taken.sum() == got["size"].sum()  # the queue ends at the budget to the word
    first = got[got.taken > 0].sort_values("position")
    assert first.position.iloc[0] == 0 and first.position.is_unique
    again = mixing.mix_sources(odd.repartition(5)).toPandas()
    columns = ["doc_id", "size", "taken"]
    assert sorted(map(str, got[columns].values.tolist())) == sorted(map(str, again[columns].values.tolist()))


def test_budget_ends_the_queue(documents):
    got = mixing.mix_sources(documents, budget=5000).toPandas()
    assert 4980 <= got.taken.sum() <= 5000
    per = got.groupby("target").taken.sum()
    assert (abs(per - per.index * got.source_size.groupby(got.target).nunique()) < per.max()).all()


def test_mixed_rows_keep_their_columns(odd):
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.where("text is null").count() == 0


def test_empty(empty):
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_plan_has_no_python(documents):
    plan = mixing.mix_sources(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def queued(rows, target, repeats=3):
    """(id -> words taken, copies in order) by a plain queue over (id, source, size, place)."""
    named = sorted(target, key=lambda s: (s is None, s or ""))
    copies = []
    for source in named:
        own, goal, start = sorted((r for r in rows if r[1] == source), key=lambda r: (r[3], r[0])), -(-target[source] // 1), 0
        for turn in range(repeats):
            for name, _, size, _ in own:
                words = max(0, min(size, goal - start))
                if words:
                    copies.append(((start + words) / target[source], named.index(source), turn, name, words, size))
                start += size
    taken, order, left = {}, [], sum(size for _, _, size, _ in rows)
    for _, _, _, name, words, size in sorted(copies):
        words = min(words, left)
        left -= words
        taken[name] = taken.get(name, 0) + words
        order += [name] * (0 < size <= 2 * words)
    return taken, order


def test_queue_decides(documents):
    """Words and order of the mix against a plain queue; another budget cuts elsewhere."""
    sized = mixing._sized(documents, "doc_id", "text", "source", "mix", False)
    rows = [(r.id, r.source, r["size"], r.place) for r in sized.collect()]
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the same targets, tested above: finish times that differ in the last bit may swap
    taken, order = queued(rows, {r.source: r.target for r in mixing.source_targets(sizes, (1, 2, 3), 3).collect()})
    got = {r.doc_id: r.taken for r in mixing.mix_sources(documents).collect()}
    assert {k: v for k, v in got.items() if v} == {k: int(v) for k, v in taken.items() if v}
    assert [r.doc_id for r in mixing.mixed_documents(documents).collect()] == order
    short = mixing.mix_sources(documents, budget=1234).toPandas()
    assert short.taken.sum() == 1234
