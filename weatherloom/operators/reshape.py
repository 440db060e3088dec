"""Readings to long and wide tables.

All reshaping is explode-then-cut: slot numbers are exploded from a constant
array and each value is sliced out of the record on its own row. There is no
array of values to build, nothing is shuffled, and scan, filter, coordinate
join, explode and write make up a single stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import month_start, slot_flags, slot_value, value_at
from ..functions.layouts import DAILY, MONTHLY, MONTHLY_MEASURES, SlotLayout

DAILY_COLUMNS = ("id", "date", "element", "dataset", "value", "lat", "lon")
MEASURES = tuple(name for name, _, _ in MONTHLY_MEASURES)
MONTHLY_COLUMNS = ("id", "date", *MEASURES, "lat", "lon")


def _with_coordinates(df: DataFrame) -> DataFrame:
    """Frames without a coordinate join get null coordinates."""
    for name in ("lat", "lon"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("float"))
    return df


def _explode_slots(df: DataFrame, layout: SlotLayout, *keep: Column | str) -> DataFrame:
    """One row per slot with ``slot`` (0-based) and what the value is cut from."""
    record = ["raw", "length"] if "raw" in df.columns else ["values"]
    slots = F.explode(F.sequence(F.lit(0), F.lit(layout.slots - 1))).alias("slot")
    return df.select(*keep, *record, slots)


def record_value(df: DataFrame, layout: SlotLayout, slot: Column) -> Column:
    """The value of a slot, from the bytes of the line or from an array."""
    if "raw" in df.columns:
        return slot_value(F.col("raw"), slot, F.col("length"), layout)
    return value_at(F.col("values"), slot)


def _flags(df: DataFrame, layout: SlotLayout, flags: bool) -> list[Column]:
    return slot_flags(F.col("raw"), F.col("slot"), F.col("length"), layout) if flags else []


def explode_values(readings: DataFrame, layout: SlotLayout, *keep: str) -> DataFrame:
    """Every slot of every reading as (slot, value), nothing dropped."""
    slots = _explode_slots(readings, layout, *keep)
    return slots.select(*keep, "slot", record_value(slots, layout, F.col("slot")).alias("value"))


def to_daily_long(
    readings: DataFrame, flags: bool = False, cluster: bool = False
) -> DataFrame:
    """One row per measured day.

    Missing values and days the month does not have are dropped. The calendar
    is evaluated once per reading: a day is real when its slot lies inside the
    month, and its date is the first of the month plus the slot.

    ``cluster`` orders each task's readings by element and month before they are
    exploded, which clusters the days too at a thirty-first of the sorting.
    """
    first = month_start(F.col("year"), F.col("month"))
    # an impossible month has no days
    dated = (
        _with_coordinates(readings)
        .withColumn("first", first)
        .withColumn("days", F.coalesce(F.dayofmonth(F.last_day("first")), F.lit(0)))
    )
    if cluster:
        dated = dated.sortWithinPartitions("element", "first")
    slots = _explode_slots(dated, DAILY, "id", "element", "dataset", "lat", "lon", "first", "days")
    return (
        slots.filter(F.col("slot") < F.col("days"))
        .select(
            "id",
            F.date_add("first", F.col("slot")).alias("date"),
            "element",
            "dataset",
            record_value(slots, DAILY, F.col("slot")).alias("value"),
            "lat",
            "lon",
            *_flags(slots, DAILY, flags),
        )
        .filter(F.col("value").isNotNull())
    )


def to_monthly_long(readings: DataFrame, flags: bool = False) -> DataFrame:
    """Twelve rows per reading, missing values kept as nulls."""
    readings = _with_coordinates(readings).withColumn(
        "january", month_start(F.col("year"), F.lit(1))
    )
    slots = _explode_slots(readings, MONTHLY, "id", "element", "dataset", "lat", "lon", "january")
    return slots.select(
        "id",
        F.add_months("january", F.col("slot")).alias("date"),
        "element",
        "dataset",
        record_value(slots, MONTHLY, F.col("slot")).alias("value"),
        "lat",
        "lon",
        *_flags(slots, MONTHLY, flags),
    )


def _measures() -> list[Column]:
    """The value in the measure of its element and dataset, nulls elsewhere."""
    return [
        F.when((F.col("element") == element) & (F.col("dataset") == dataset), F.col("value")).alias(
            name
        )
        for name, element, dataset in MONTHLY_MEASURES
    ]


def to_monthly_sparse(readings: DataFrame, keep_dataset: bool = False) -> DataFrame:
    """Twelve rows per reading with one of the nine measures filled.

    Rows of an unknown dataset or element hold nine nulls. ``keep_dataset``
    adds the dataset as a column, for partitioned output.
    """
    long = to_monthly_long(readings)
    extra = ["dataset"] if keep_dataset else []
    return long.select("id", "date", *_measures(), "lat", "lon", *extra)


def to_monthly_wide(sparse: DataFrame) -> DataFrame:
    """Merge sparse rows to one row per station and month.

    A plain grouped maximum: the partial aggregate collapses the rows of a task
    before the one shuffle, so a station with very many rows costs no more than
    its number of months.
    """
    keys = ["id", "date", "lat", "lon", *snapshot_key(sparse)]
    return sparse.groupBy(*keys).agg(*[F.max(name).alias(name) for name in MEASURES]).select(
        *MONTHLY_COLUMNS, *snapshot_key(sparse)
    )


def snapshot_key(rows: DataFrame) -> list[str]:
    """Rows of several snapshots are never merged: their date is a key like others."""
    return ["snapshot_date"] if "snapshot_date" in rows.columns else []
