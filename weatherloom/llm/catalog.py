"""One query for each operator of this folder, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.llm.graph_search import nearest
from weatherloom.llm.interpolation import score_texts
from weatherloom.llm.line_rules import fit_line_model, line_rules
from weatherloom.llm.middle import ORACLE as MIDDLE_ORACLE
from weatherloom.llm.middle import fill_in_middle, restored
from weatherloom.llm.mixing import ORACLE as MIX_ORACLE
from weatherloom.llm.mixing import mix_sources
from weatherloom.llm.near_dedup import ORACLE as NEAR_ORACLE
from weatherloom.llm.near_dedup import near_duplicates
from weatherloom.llm.part_enum import ORACLE as JOIN_ORACLE
from weatherloom.llm.part_enum import alike_components
from weatherloom.llm.pieces import encode_pieces
from weatherloom.llm.quality_model import fit_quality, held_out, quality_scores
from weatherloom.llm.secret_scan import ORACLE as SECRET_ORACLE
from weatherloom.llm.secret_scan import scan_secrets
from weatherloom.llm.severity import fit_severity, severity
from weatherloom.llm.token_counts import count_tokens
from weatherloom.llm.vector_codes import ORACLE as CODES_ORACLE
from weatherloom.llm.vector_codes import fit_codes, label_errors

QUALITY_CUT = 0.3


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Four best segmentations of each text, ids and scores; the hash is of the text that the ids give."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(table(spark, folder, "documents"), model, alternatives=True, decoded=True)
    return encoded.withColumn("decoded", F.sha2("decoded", 256)).withColumnRenamed("decoded", "decoded_sha256")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return severity(documents, fit_severity(documents, table(spark, folder, "labels")))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return line_rules(documents, fit_line_model(documents, table(spark, folder, "labels")))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    forest = fit_quality(documents, table(spark, folder, "labels"))
    return quality_scores(documents, forest).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return alike_components(table(spark, folder, "documents"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """What the output is restored to is hashed, not the text that came in."""
    cut = fill_in_middle(table(spark, folder, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    fitted = fit_codes(table(spark, folder, "embeddings"))
    return label_errors(fitted.codes).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(fitted.sha256()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_toxicity": op3_toxicity,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_token_counts": op5_token_counts,
    "op6_secret_scan": op6_secret_scan,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES: dict[str, str] = {
    "op1_source_mixing": MIX_ORACLE,
    "op6_secret_scan": SECRET_ORACLE,
    "op10_minhash_near_dedup": NEAR_ORACLE,
    "op11_ngram_jaccard_join": JOIN_ORACLE,
    "op12_fill_in_middle": MIDDLE_ORACLE,
    "op13_vector_codes": CODES_ORACLE,
}
