"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str, text_col: str, where=None
) -> DataFrame:
    """(id, text, label) of at most ``most`` labelled documents, the same in every run.

    Ids are taken in the order of their hash. Repeated labels of an id are averaged,
    null ones skipped. Each id is one row, whatever number of documents repeats it: the
    smallest of their texts (null only if all are), found with a partial step, so an id
    that holds a third of all rows sends one text from each task. The labels that stay
    are at most ``most`` rows, so they are broadcast.
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("label"))
        .where("id is not null and label is not null")
        .groupBy("id")
        .agg(F.avg("label").alias("label"))
    )
    if where is not None:
        chosen = chosen.where(where(F.col("id")))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), "id").groupBy("id")
    return found.agg(F.min("text").alias("text"), F.first("label").alias("label"))
