"""Quality checks described in the archive format documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.layouts import MONTHLY, SOURCE_PRIORITY
from .reshape import record_value

# months without any value on both sides that make a value isolated
ISOLATION_MONTHS = 18
SERIES = tuple(f"m{i + 1:02d}" for i in range(MONTHLY.slots))


def passed_quality(long: DataFrame, flag: str = "qflag") -> DataFrame:
    """Values that failed no quality check."""
    return long.filter(F.col(flag) == "")


def inconsistent_months(wide: DataFrame, dataset: str = "raw") -> DataFrame:
    """Months whose minimum is above their maximum."""
    low, high = f"min_{dataset}", f"max_{dataset}"
    return wide.filter(F.col(low) > F.col(high)).select("id", "date", low, high)


def average_from_extremes(wide: DataFrame, dataset: str = "raw") -> DataFrame:
    """Months with the average recomputed as the middle of both extremes."""
    middle = ((F.col(f"max_{dataset}") + F.col(f"min_{dataset}")) / F.lit(2.0)).cast("float")
    return wide.withColumn(f"avg_{dataset}_computed", middle)


def isolated_values(monthly_long: DataFrame, months: int = ISOLATION_MONTHS) -> DataFrame:
    """Values with no other value within ``months`` months on either side.

    Rows are first reduced to one per station, dataset, element and *year* with
    twelve values, so that both shuffles carry a row per year and a window holds
    at most one row per calendar year. Only the nearest months count: those in
    the row itself, the last one of the year before it and the first after it.
    """
    series = ["id", "dataset", "element"]
    year = monthly_long.filter(F.col("value").isNotNull() & F.col("date").isNotNull()).groupBy(
        *series, F.year("date").alias("year")
    )
    values = year.agg(
        *[
            F.max(F.when(F.month("date") == i + 1, F.col("value"))).alias(name)
            for i, name in enumerate(SERIES)
        ]
    )
    filled = F.array_compact(
        F.array(
            *[
                F.when(F.col(name).isNotNull(), F.struct((F.col("year") * 12 + i).alias("month"), F.col(name).alias("value")))
                for i, name in enumerate(SERIES)
            ]
        )
    )
    order = Window.partitionBy(*series).orderBy("year")
    rows = values.select(*series, "year", filled.alias("filled"))
    rows = rows.select(
        *series,
        "filled",
        F.lag(F.element_at("filled", -1)["month"]).over(order).alias("last_before"),
        F.lead(F.element_at("filled", 1)["month"]).over(order).alias("first_after"),
    )
    place = F.posexplode("filled").alias("place", "own")
    one = rows.select(*series, "filled", "last_before", "first_after", place)
    before = F.coalesce(F.get("filled", F.col("place") - 1)["month"], F.col("last_before"))
    after = F.coalesce(F.get("filled", F.col("place") + 1)["month"], F.col("first_after"))
    month = F.col("own.month")
    alone = (before.isNull() | (month - before > months)) & (after.isNull() | (after - month > months))
    date = F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1))
    return one.filter(alone).select(*series, date.alias("date"), F.col("own.value").alias("value"))


def annual_series(readings: DataFrame) -> DataFrame:
    """One row per station, dataset, element and year with columns m01 to m12."""
    return readings.groupBy("id", "dataset", "element", "year").agg(
        *[
            F.max(record_value(readings, MONTHLY, F.lit(i))).alias(name)
            for i, name in enumerate(SERIES)
        ]
    )


def duplicate_years(readings: DataFrame) -> DataFrame:
    """Annual series that occur in more than one year of a station.

    Years without any value are no series. Grouping by the values themselves
    finds the copies without comparing pairs of years.
    """
    series = annual_series(readings).filter(F.coalesce(*SERIES).isNotNull())
    return (
        series.groupBy("id", "dataset", "element", *SERIES)
        .agg(
            F.count(F.lit(1)).alias("n_years"),
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
        )
        .filter(F.col("n_years") > 1)
        .select("id", "dataset", "element", "n_years", "first_year", "last_year")
    )


def best_source(
    daily_long: DataFrame,
    priority: str = SOURCE_PRIORITY,
    keys: Sequence[str] = ("id", "date", "element"),
) -> DataFrame:
    """One row per key, with all its columns: that of the most trusted source.

    Unlisted sources rank last and equal ranks go to the largest value, then to
    the smallest of the other columns in order. A grouped minimum keeps one
    candidate per key and task before the shuffle, where a ranking window would
    ship every copy to one task.
    """
    listed = F.nullif(F.instr(F.lit(priority), F.col("sflag")), F.lit(0))
    rank = F.coalesce(F.when(F.col("sflag") != "", listed), F.lit(len(priority) + 1))
    rest = [name for name in daily_long.columns if name not in (*keys, "value")]
    best = F.min(F.struct(rank.alias("rank"), (-F.col("value")).alias("negated"), *rest))
    own = {name: F.col(name) for name in keys}
    own |= {name: F.col(f"best.{name}").alias(name) for name in rest}
    own["value"] = (-F.col("best.negated")).alias("value")
    return (
        daily_long.groupBy(*keys)
        .agg(best.alias("best"))
        .select(*(own[name] for name in daily_long.columns))
    )
