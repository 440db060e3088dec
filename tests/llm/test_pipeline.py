import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from weatherloom.llm import mixing, quality_model, secret_scan
from weatherloom.llm.pieces import load

from .conftest import FOLDER
from .test_near_dedup import by_force


def test_stages_take_effect(spark, tmp_path, labels, documents):
    """Each stage against what its operator, or brute force, says of its input."""
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        kept[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = kept[name][1]
        if name != "sentencepiece":
            assert docs.columns == documents.columns

    def ids(frame):
        return sorted(r.doc_id for r in frame.select("doc_id").collect())

    before, after = kept["quality_classifier"]
    scores = quality_model.quality_scores(before, quality_model.fit_quality(before, labels))
    assert ids(after) == ids(scores.where("score >= 0.3"))
    good = labels.where("quality = 1").join(before, "doc_id").count()
    assert after.join(labels.where("quality = 1"), "doc_id").count() >= 0.97 * good

    before, after = kept["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == sorted(i for i, n, c in by_force(rows, 80) if i == c or not n)

    before, after = kept["secret_scan"]
    assert ids(after) == ids(secret_scan.scan_secrets(before).where("n_live = 0"))

    before, after = kept["source_mix"]
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    mixed = mixing.mix_sources(before).where("size > 0")
    assert ids(after) == ids(mixed.select("doc_id", F.explode(F.array_repeat("doc_id", copies))))

    before, after = kept["sentencepiece"]
    model = load(public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r.doc_id, model.encode(r.text)) for r in before.collect())
    assert sorted((r.doc_id, r.ids) for r in after.collect()) == want
    same = before.select("doc_id", F.sha2("text", 256).alias("sha")).distinct().join(after, "doc_id")
    assert same.where("sha <> decoded_sha256").count() == 0


def test_run_takes_odd_tables(spark, odd, tmp_path):
    folder = str(tmp_path / "tables")
    odd.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(None, 1), (1, None), (4, 1), (4, 0)], "doc_id long, quality int").write.parquet(
        f"{folder}/labels.parquet"
    )
    result = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "ids", "n_pieces"} <= set(result.columns)
    empty = str(tmp_path / "empty")
    odd.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_run_leaves_only_its_result(spark, tmp_path, monkeypatch):
    """All that the stages store on the way goes, also when one of them fails."""
    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr("weatherloom.session.shared_folder", lambda spark: str(shared))
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    assert [p.name.split("-")[0] for p in shared.iterdir()] == ["sentencepiece"]

    def broken(spark, docs, sf_dir):
        raise RuntimeError("broken")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:2], ("broken", broken)])
    before = set(shared.iterdir())
    try:
        corpus_pipeline.run(spark, FOLDER)
    except RuntimeError:
        pass
    assert set(shared.iterdir()) == before
