import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weatherloom.llm.pieces import SCALE, decode_pieces, encode_pieces, load

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def every_segmentation(model, unit):
    def onward(i):
        if i == len(unit):
            return [(0, ())]
        out, alone = [], False
        for j in range(i + 1, len(unit) + 1):
            entry = model.table.get(unit[i:j])
            if entry:
                alone = alone or j == i + 1
                out += [(entry[1] + s, entry[:1] + ids) for s, ids in onward(j)]
        if not alone:
            ids = tuple(model.letter_bytes(unit[i]))
            out += [(model.byte_score * len(ids) + s, ids + more) for s, more in onward(i + 1)]
        return out

    return sorted(onward(0), key=lambda way: -way[0])


@pytest.mark.parametrize("scores", ["rank", "model"])
@pytest.mark.parametrize("text", ["hello wor", "  aaaa x", "é▁日本\n\nx y", "abc", "the\tin", " "])
def test_n_best_is_exact(text, scores):
    model = load(MODEL, scores)
    want = every_segmentation(model, " " + text)
    for n in (1, 3, 8):
        got = model.encode_n_best(text, n)
        assert [round(s * SCALE) for s, _ in got] == [s for s, _ in want[:n]]
        assert len({tuple(ids) for _, ids in got}) == len(got)
        assert all((round(s * SCALE), tuple(ids)) in want for s, ids in got)
        assert [s for s, _ in model.n_best(" " + text, n)] == [s for s, _ in want[:n]]


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_round_trip(text):
    model = load(MODEL)
    assert model.decode(model.encode(text)) == text


def test_odd_rows(odd):
    got = encode_pieces(odd, MODEL, alternatives=True, decoded=True).withColumn("back", decode_pieces(F.col("ids"), MODEL))
    rows = got.collect()
    key = lambda pair: (pair[0] is None, pair[0] or 0, pair[1])
    want = sorted(((r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()), key=key)
    assert sorted(((r.doc_id, r.back) for r in rows), key=key) == want
    for r in rows:
        assert r.decoded == r.back and r.n_pieces == len(r.ids) and r.n_best[0] == r.ids and r.n_best_scores[0] == r.score
        assert r.n_best_scores == sorted(r.n_best_scores, reverse=True)
        assert len({tuple(ids) for ids in r.n_best}) == len(r.n_best) == len(r.n_best_scores)


def test_decoding_of_any_ids(spark):
    model = load(MODEL)
    bytes_of = model.letter_bytes("é")
    rows = [([], ""), (None, None), (bytes_of, "é"), (bytes_of[:1], "\ufffd"), ([0, 1, 2], ""), (model.encode("a b"), "a b")]
    frame = spark.createDataFrame([(ids,) for ids, _ in rows], "ids array<int>").coalesce(1)
    assert [r[0] for r in frame.select(decode_pieces(F.col("ids"), MODEL)).collect()] == [t for _, t in rows]


def test_empty(empty):
    assert encode_pieces(empty, MODEL).count() == 0


def test_query_returns_all_segmentations(spark, tmp_path):
    from weatherloom.llm.catalog import op2_sentencepiece

    texts = [(1, "hello world, hello"), (2, ""), (3, None), (4, "é▁日本\n\nx y"), (5, "a")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    model = load(MODEL)
    got = {r.doc_id: r for r in op2_sentencepiece(spark, str(tmp_path)).collect()}
    for key, text in texts:
        want = model.encode_n_best(text or "", 4)
        assert got[key].n_best == [ids for _, ids in want]
        assert got[key].n_best_scores == pytest.approx([s for s, _ in want])
        assert got[key].n_best[0] == got[key].ids
        assert {model.decode(ids) for ids in got[key].n_best} == {text or ""}


@pytest.mark.parametrize("scores", ["rank", "model"])
def test_units_segmented_together(scores):
    from weatherloom.llm.pieces import SHORT, Units

    model = load(MODEL, scores)
    rng = random.Random(5)
    letters = "aaaeehilnorstth éñ.,x"
    units = [" " + "".join(rng.choices(letters.replace(" ", ""), k=rng.randrange(1, 30))) for _ in range(3000)]
    units += ["a", "  ", "x" * SHORT, "the" * 100, "\n", "日本", " a▁b", "あ\U0001f600"]
    units = list(dict.fromkeys(units))
    plain = model.plain(units)
    assert plain.sum() > 2000 and plain[units.index("x" * SHORT)]
    assert not plain[units.index("the" * 100)] and not plain[units.index("\n")]
    some = [u for u, p in zip(units, plain, strict=True) if p]
    ids, sizes, total, loss = model.segment_all(some)
    ends = sizes.cumsum().tolist()
    got = [(ids[b:e].tolist(), t, x) for b, e, t, x in zip([0, *ends], ends, total.tolist(), loss.tolist())]
    assert got == [model.segment(u) for u in some]
    # the same numbers whether a unit was learnt with others or asked for alone
    together, alone = Units(model), Units(model)
    together.learn(units[::2])
    together.learn(units)
    for u in units:
        a, b = together[u], alone[u]
        assert together.name(a) == u and together.ids_of(a) == alone.ids_of(b)
        assert (together.score[a], together.loss[a]) == (alone.score[b], alone.loss[b])
    assert len(together) == len(together.names) == len(units)
    together.learn([])
