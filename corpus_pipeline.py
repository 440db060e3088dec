"""A training corpus from ``documents``, stage by stage.

Every stage takes the rows that the stage before it kept. Null and empty texts go
through like others; a null id is a row like others, except that it names no group
of copies. Repeated rows are one document after the second stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.llm.mixing import mixed_documents
from weatherloom.llm.near_dedup import drop_near_duplicates
from weatherloom.llm.pieces import encode_pieces
from weatherloom.llm.quality_model import fit_quality, good_documents
from weatherloom.llm.scratch import ending
from weatherloom.llm.secret_scan import without_live_secrets
from weatherloom.session import remove, scratch_path

QUALITY_CUT = 0.3
# near copies share 80 % of their shingles; thirty bands of four rows miss one such pair
# in ten million
NEAR_PERCENT = 80
NEAR_BANDS = 30
NEAR_ROWS = 4


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more."""
    forest = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return good_documents(docs, forest, QUALITY_CUT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return drop_near_duplicates(docs, percent=NEAR_PERCENT, bands=NEAR_BANDS, rows=NEAR_ROWS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a live credential; copied examples may stay."""
    return without_live_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix has it, in the mix's order."""
    return mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, score, n_best_scores and a hash of what the ids decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(docs, model, decoded=True)
    return encoded.withColumn("decoded", F.sha2("decoded", 256)).withColumnRenamed("decoded", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]

ORACLE_SQL = None  # the classifier is a fitted model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage is written to the shared folder and reread.

    When a stage is done, also by an error, everything it has stored on the way and what
    it has read is removed: only the last stage's rows stay.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        try:
            with ending(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
        finally:
            if before:
                remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
