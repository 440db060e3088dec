"""Line rules, quality classifier and severity: counts by force, models on held-out rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import catalog, line_rules, quality_model, severity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LARGER = "/root/testdata/sf0.01"


def base_counts(text):
    text = text or ""
    words, seen, repeats = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 8))
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)
    )


MORE = ["a b\na b\n\na b \n é ü", "\n", " a b c d e f g h " * 3, "x\r\ny\r\nx\r\n", "one two " * 40, "p q\np q"]


def test_base_rules(spark, documents, odd, labels):
    model = line_rules.fit_line_model(documents, labels)
    more = spark.createDataFrame(list(enumerate(MORE)), "doc_id long, text string")
    for frame in (documents, odd, more):
        rows = line_rules.line_rules(frame, model).collect()
        want = [(r.doc_id, *base_counts(r.text)) for r in frame.select("doc_id", "text").collect()]
        got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]
        assert sorted(got, key=str) == sorted(want, key=str)
        for r in rows:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert r.kept == (not r.base_failed and r.content_share >= 0.5)


def test_viterbi_equals_all_labellings():
    rng = np.random.default_rng(3)
    model = line_rules.ChainModel(rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    x, doc = rng.normal(size=(17, 4)), np.repeat([0, 2, 3, 9], [1, 6, 2, 8])
    found = model.decode(x, doc)
    for d in np.unique(doc):
        score = x[doc == d] @ model.emit
        n = len(score)

        def total(labels, score=score):
            moves = sum(model.move[a, b] for a, b in zip(labels, labels[1:]))
            return model.start[labels[0]] + moves + sum(score[i, k] for i, k in enumerate(labels))

        ways = [[(w >> i) & 1 for i in range(n)] for w in range(2**n)]
        assert total(found[doc == d].tolist()) == pytest.approx(max(map(total, ways)))


def test_chain_model_learns():
    rng = np.random.default_rng(4)
    chain = np.repeat(np.arange(200), 10)
    label = np.repeat(rng.integers(0, 2, 400), 5)  # runs of five equal labels
    x = np.stack([np.ones(2000), label + rng.normal(size=2000)], axis=1)
    model = line_rules.fit_chain(x, label, chain)
    assert (model.decode(x, chain) == label).mean() > ((x[:, 1] > 0.5) == label).mean() + 0.05


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_on_held_out_rows(spark):
    got = catalog.op9_quality_classifier(spark, LARGER).toPandas()
    assert (got.held_out == [fold(i, 5) == 0 for i in got.doc_id]).all()
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.3)).all()
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95
    assert (held[held.quality == 1].predicted == 1).mean() > 0.97


def test_line_rules_keep_good_documents(spark):
    got = catalog.op8_quality_rules(spark, LARGER).toPandas()
    both = got.merge(spark.read.parquet(f"{LARGER}/labels.parquet").toPandas(), on="doc_id")
    usual = both[~both.base_failed]
    assert (usual[usual.quality == 1].kept).mean() > 0.97
    assert (~usual[usual.quality == 0].kept).mean() > 0.75


def test_flat_trees_equal_walks():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality_model.fit_forest(x, y)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.97

    def walk(row):
        total = forest.prior
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert forest.score(x[:50]) == pytest.approx([walk(r) for r in x[:50]])
    assert forest.score(x[:0]).shape == (0,)
    assert quality_model.fit_forest(x, np.ones(500)).score(x[:2]) == pytest.approx([0.999, 0.999])


def test_quality_of_odd_rows(odd, empty, labels, documents):
    forest = quality_model.fit_quality(odd, labels)
    got = quality_model.quality_scores(odd, forest)
    assert got.count() == odd.count() and got.where("score is null or isnan(score)").count() == 0
    assert quality_model.quality_scores(empty, forest).count() == 0
    nothing = quality_model.fit_quality(documents, labels.limit(0))
    assert nothing.score(quality_model.statistics(pa.array(["x", None]))) == pytest.approx([0.5, 0.5])
    kept = quality_model.good_documents(odd, forest, 0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_severity_orders_texts(spark):
    documents = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    learned = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = severity.fit_severity(documents, learned)
    assert (np.diff(model.thresholds) > 0).all()
    got = severity.severity(documents, model).toPandas().merge(labels.toPandas(), on="doc_id", suffixes=("", "_label"))
    held = got[[fold(i, 5) == 0 for i in got.doc_id]]
    assert held[held.toxic_label == 0].toxic.mean() < 0.02
    assert held[held.toxic_label == 1].toxic.mean() > 0.5
    assert held[held.toxic_label == 1].severity.mean() > 10 * held[held.toxic_label == 0].severity.mean()
    few = model.at_least(pa.array(["an idiot here", "idiot moron scum trash idiot loser clown stupid", "", None]))
    assert (np.diff(few, axis=1) <= 0).all()
    total = few.sum(axis=1)
    assert total[1] > total[0] > total[2] == total[3]


def test_cumulative_fit_recovers_order():
    rng = np.random.default_rng(6)
    score = rng.normal(size=600) * 2
    grade = (score[:, None] + rng.logistic(size=(600, 1)) * 0.3 > [-1, 0.5, 2]).sum(axis=1)
    rows = np.arange(600)
    weights, cuts = severity.fit_cumulative(rows, np.zeros(600, dtype=int), score, grade, 1, 3)
    assert (np.diff(cuts) > 0).all() and weights[0] > 0
    assert cuts / weights[0] == pytest.approx([-1, 0.5, 2], abs=0.35)


def test_severity_of_odd_rows(odd, empty, documents, labels):
    model = severity.fit_severity(documents, labels)
    got = severity.severity(odd, model)
    assert got.count() == odd.count() and got.where("severity is null or isnan(severity)").count() == 0
    assert severity.severity(empty, model).count() == 0
    nothing = severity.fit_severity(documents, labels.limit(0))
    assert severity.severity(odd, nothing).where("toxic").count() == 0


def test_sample_is_bounded_by_ids(spark):
    """An id that holds a third of all rows is one labelled text."""
    from weatherloom.llm.labelled import labelled_sample

    rows = [(1, f"hot {i % 7}") for i in range(3000)] + [(i, f"text {i}") for i in range(2, 6000)] + [(1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 200)] + [(1, 0), (None, 1)], "doc_id long, quality int")
    got = labelled_sample(docs, labels, "quality", 150, "doc_id", "text").collect()
    assert len(got) == len({r.id for r in got}) == 150
    whole = {r.id: r for r in labelled_sample(docs, labels, "quality", 500, "doc_id", "text").collect()}
    assert len(whole) == 199 and (whole[1].text, whole[1].label) == ("hot 0", 0.5)


def test_all_lines_are_learned_from(spark):
    """Boilerplate that stands after many lines only; chains of one text are cut."""
    from weatherloom.llm.line_rules import CHAIN_LINES, cut_chains, fit_line_model, line_rules

    assert cut_chains(np.array([3, 0, 5]), 2).tolist() == [0, 0, 1, 2, 2, 3, 3, 4]
    good = "\n".join(f"plain words of the number {i} line are here." for i in range(CHAIN_LINES))
    bad = "\n".join("| # | $ | 12 | 34 |" for _ in range(400))
    rows = [(i, good, 1) for i in range(0, 80, 2)] + [(i, f"{good}\n{bad}", 0) for i in range(1, 21, 2)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = fit_line_model(docs, labels)
    late = spark.createDataFrame([(1, f"{good}\n{bad}"), (2, good)], "doc_id long, text string")
    share = {r.doc_id: r.content_share for r in line_rules(late, model).collect()}
    assert share[1] < 0.5 < share[2]


def test_line_rules_of_empty_tables(spark, empty, labels):
    from weatherloom.llm.line_rules import fit_line_model, line_rules

    model = fit_line_model(empty, labels)
    assert line_rules(empty, model).count() == 0
    assert not line_rules(spark.createDataFrame([(1, "a b\nc")], "doc_id long, text string"), model).first().kept


def plain_boosting(x, y, trees, depth, rate, bins, ridge, least):
    """Scores after boosting that tries every bin edge of every node, row by row."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    share = y.mean()
    total = np.full(len(y), np.log(share / (1 - share)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = y - p, p * (1 - p)

        def part(rows):
            return slope[rows].sum() ** 2 / (curve[rows].sum() + ridge)

        leaves = [np.arange(len(y))]
        for _ in range(depth):
            following = []
            for rows in leaves:
                best, cut = 1e-9, None
                for f in range(x.shape[1]):
                    found = [(0.0, None)]
                    for edge in edges[f]:
                        left, right = rows[x[rows, f] <= edge], rows[x[rows, f] > edge]
                        if min(len(left), len(right)) >= least:
                            found.append((part(left) + part(right) - part(rows), (f, edge)))
                    gain, where = max(found, key=lambda c: c[0])
                    if gain > best + (1e-9 if cut else 0):
                        best, cut = gain, where
                if cut:
                    following += [rows[x[rows, cut[0]] <= cut[1]], rows[x[rows, cut[0]] > cut[1]]]
                else:
                    following += [rows, rows[:0]]
            leaves = following
        for rows in leaves:
            if len(rows):
                total[rows] += rate * slope[rows].sum() / (curve[rows].sum() + ridge)
    return 1 / (1 + np.exp(-total))


def test_splits_equal_those_of_a_full_search():
    rng = np.random.default_rng(11)
    x = np.stack([rng.normal(size=400), rng.integers(0, 4, 400), rng.exponential(size=400), np.ones(400)], axis=1)
    y = ((x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=400) * 0.5) > 1).astype(float)
    options = {"trees": 6, "depth": 3, "rate": 0.3, "bins": 16, "ridge": 1.0, "least": 5.0}
    assert quality_model.fit_forest(x, y, **options).score(x) == pytest.approx(plain_boosting(x, y, **options))


def plain_features(text):
    """Words and their beginnings, with how often each occurs, as bytes of the text."""
    data = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    cut = bytes(32 if severity.BETWEEN[c] else c for c in range(256))
    words = [w for w in data.translate(cut).split(b" ") if w]
    return Counter(("word", w) for w in words) + Counter(("start", w[:k]) for w in words for k in severity.BEGINNINGS if len(w) > k)


def test_severity_equals_plain_python(spark):
    """Which features are kept, by a plain likelihood-ratio test, and the severity they give."""
    documents = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    model = severity.fit_severity(documents, labels)
    marks = {}
    for r in labels.where("doc_id is not null and toxic is not null").collect():
        marks.setdefault(r.doc_id, []).append(r.toxic)
    rows = [(r.doc_id, r.text) for r in documents.collect() if r.doc_id in marks]
    inside, total = Counter(), Counter()
    toxic = {i: np.mean(v) >= 0.5 for i, v in marks.items()}
    for name, text in rows:
        for feature in plain_features(text):
            total[feature] += 1
            inside[feature] += toxic[name]
    n = [sum(toxic[i] for i, _ in rows), sum(not toxic[i] for i, _ in rows)]

    def ratio(a, both):
        cells = [(a, both, n[0]), (both - a, both, n[1]), (n[0] - a, sum(n) - both, n[0]), (n[1] - both + a, sum(n) - both, n[1])]
        return 2 * sum(c * np.log(c * sum(n) / (row * column)) for c, row, column in cells if c)

    usual = {f: ratio(inside[f], t) for f, t in total.items() if t >= severity.LEAST_TEXTS}
    kept = {f for f, r in usual.items() if r > 2 * np.log(100 * len(usual))}
    assert 0 < len(kept) < severity.WORDS_KEPT

    def hashed(feature):
        kind, data = feature
        text = pa.array([data.decode("utf-8", "ignore") if kind == "word" else data.decode("utf-8", "ignore") + "zzzz"])
        found = list(severity.features(text))
        if kind == "word":
            return int(found[0][1][0])
        return int(found[1 + severity.BEGINNINGS.index(len(data))][1][0])

    plain = {f for f in kept if f[1].decode("utf-8", "ignore").encode() == f[1]}
    weight = {f: model.weights[np.searchsorted(model.words, np.uint64(hashed(f)))] for f in plain}
    assert {hashed(f) for f in plain} <= set(model.words.tolist()) and len(kept) == len(model.words)
    got = {r.doc_id: r.severity for r in severity.severity(documents, model).collect()}
    for name, text in rows:
        found = plain_features(text)
        if not any(f in found for f in kept - plain):
            score = sum(np.log1p(c) * weight[f] for f, c in found.items() if f in weight)
            want = sum(1 / (1 + np.exp(min(t - score, 500))) for t in model.thresholds)
            assert got[name] == pytest.approx(want, abs=1e-9)
