"""Station queries: filters, means, coverage, comparison.

All of them are narrow filters or grouped aggregates with a partial step, so
element, box and column choices reach the Parquet scan and only groups, not
rows, are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import point
from .reshape import snapshot_key


def of_element(daily: DataFrame, element: str) -> DataFrame:
    return daily.filter(F.col("element") == element)


def within_bbox(
    df: DataFrame, south: float, north: float, west: float, east: float
) -> DataFrame:
    """Rows inside a box, borders included.

    The bounds are compared as 32-bit values like the coordinates themselves,
    which also lets the comparison be pushed into a Parquet scan.
    """
    bound = lambda number: F.lit(number).cast("float")
    return df.filter(
        F.col("lat").between(bound(south), bound(north))
        & F.col("lon").between(bound(west), bound(east))
    )


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chosen columns of the rows that have all of them."""
    return df.select(*columns).dropna(how="any")


def monthly_mean(daily: DataFrame, element: str | None = None) -> DataFrame:
    """Mean value per calendar month over all stations.

    A month is labelled by its last day. Months without data between the first
    and the last one appear with a null mean.
    """
    if element is not None:
        daily = of_element(daily, element)
    # accumulated in double precision: a float sum would lose digits
    means = daily.groupBy(F.last_day("date").alias("month")).agg(
        F.avg(F.col("value").cast("double")).alias("mean_value")
    )
    # Each month is followed by the empty months up to the next one with data.
    # The window sees one row per calendar month, at most 12 x 9,999 of them
    # whatever the input; joining a calendar instead would scan the input twice.
    following = F.lead("month").over(Window.orderBy("month"))
    first = F.trunc("month", "MM")
    last = F.coalesce(F.add_months(F.trunc(following, "MM"), -1), first)
    return (
        means.withColumn("last", last)
        .select(
            "month",
            "mean_value",
            F.explode(F.sequence(first, F.col("last"), F.expr("interval 1 month"))).alias("first"),
        )
        .select(
            F.last_day("first").alias("month"),
            F.when(F.last_day("first") == F.col("month"), F.col("mean_value")).alias("mean_value"),
        )
    )


def coordinate_coverage(df: DataFrame) -> DataFrame:
    """Number of rows, rows with a latitude, and their share in percent."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("lat").alias("with_coordinates"),
        F.try_divide(F.count("lat") * F.lit(100.0), F.count(F.lit(1))).alias("percent"),
    )


def station_coordinates(df: DataFrame) -> DataFrame:
    """Distinct (id, lat, lon)."""
    return df.select("id", "lat", "lon").distinct()


def station_points(df: DataFrame) -> DataFrame:
    """Distinct stations with their coordinates as a point."""
    return station_coordinates(df).withColumn("geometry", point(F.col("lon"), F.col("lat")))


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


def compare_quality(
    monthly: DataFrame, element: str = "max", base: str = "raw", corrected: str = "fls52"
) -> DataFrame:
    """Months that have a value in two datasets, and the correction made.

    Takes sparse or merged rows, also the union of two dataset files. Both
    sides meet in one grouped maximum instead of a join of two scans: rows
    without either value are dropped first, and the partial aggregate bounds
    what a station can send through the shuffle.
    """
    before, after = f"{element}_{base}", f"{element}_{corrected}"
    paired = (
        monthly.filter(F.col(before).isNotNull() | F.col(after).isNotNull())
        .groupBy("id", "date", *snapshot_key(monthly))
        .agg(F.max(before).alias(before), F.max(after).alias(after))
    )
    return complete_rows(paired, ["id", "date", before, after]).withColumn(
        "difference", F.col(after) - F.col(before)
    )
