"""Counts over readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.layouts import SlotLayout
from .reshape import explode_values


def reading_counts(readings: DataFrame) -> DataFrame:
    """Readings per dataset."""
    return readings.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_readings"))


def value_count(readings: DataFrame, layout: SlotLayout) -> DataFrame:
    """Number of values that are not missing, and of slots."""
    return explode_values(readings, layout).agg(
        F.count("value").alias("n_values"), F.count(F.lit(1)).alias("n_slots")
    )
