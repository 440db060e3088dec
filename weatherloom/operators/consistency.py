"""Checks of values against the days, months and elements next to them.

A value meets the days or months around it by being repeated for them: rows with equal
keys are then grouped, with a partial step. No window runs along a station's record, no
month border is special, and a gap is simply a row that is not there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, remove, stored
from .joins import BROADCAST_BYTES, sized_join
from .neighbours import NEIGHBOURS, WITHIN_KM, nearest_stations

SERIES = ("id", "dataset", "element")
SPIKE = 25.0
LAGGED_RANGE = 40.0
LAG_DAYS = 1
COPIES_SINCE = 2000
REGION_CHANGE = 1.0
REGION_SHARE = 0.5
# generous in-memory bytes of a station, element and date
MASK_ROW_BYTES = 128


def _present(long: DataFrame) -> DataFrame:
    return long.filter(F.col("value").isNotNull() & F.col("date").isNotNull())


def _with_around(rows: DataFrame, shifted: dict[str, Column], keys: list[str]) -> DataFrame:
    """The largest value per key and place; ``shifted`` gives the key date of each place."""
    places = [F.struct(date.alias("date"), F.lit(name).alias("place")) for name, date in shifted.items()]
    spread = rows.select(*keys, "value", F.explode(F.array(*places)).alias("at"))
    return spread.groupBy(*keys, F.col("at.date").alias("date")).agg(
        *[F.max(F.when(F.col("at.place") == name, F.col("value"))).alias(name) for name in shifted]
    )


def spikes(daily: DataFrame, limit: float = SPIKE) -> DataFrame:
    """(id, element, date, value, before, after): values far above or below both neighbours.

    A value that is at least ``limit`` above the values of the day before and the day
    after, or at least ``limit`` below both. Both days need a value. Rows that repeat a
    station, element and date are one, with the largest value.
    """
    date = F.col("date")
    shifted = {"own": date, "before": F.date_add(date, 1), "after": F.date_sub(date, 1)}
    met = _with_around(_present(daily), shifted, ["id", "element"])
    # rounded like the tenths they come from: floats differ in the last bits
    rise, fall = (F.round((F.col("own") - F.col(c)).cast("double"), 4) for c in ("before", "after"))
    far = ((rise >= limit) & (fall >= limit)) | ((rise <= -limit) & (fall <= -limit))
    return met.filter(far).select("id", "element", "date", F.col("own").alias("value"), "before", "after")


def lagged_ranges(
    daily: DataFrame,
    high: str = "TMAX",
    low: str = "TMIN",
    limit: float = LAGGED_RANGE,
    days: int = LAG_DAYS,
) -> DataFrame:
    """(id, date, element, value, bound): values too far from the other element around them.

    A ``high`` value at least ``limit`` above the largest ``low`` value (``bound``) of
    the ``days`` days on both sides and the day itself; a ``low`` value at least
    ``limit`` below the smallest ``high`` value of these days. One value around is
    enough for a bound; without any there is none. Repeated rows are one, with the
    largest value.
    """
    single = _present(daily).filter(F.col("element").isin(high, low)).groupBy("id", "date", "element")
    single = single.agg(F.max("value").alias("value"))
    step = F.explode(F.sequence(F.lit(-days), F.lit(days))).alias("step")
    spread = single.select("id", "element", "value", F.col("date").alias("day"), step)
    at = F.date_add("day", F.col("step"))
    is_high, here = F.col("element") == high, F.col("step") == 0
    met = spread.groupBy("id", at.alias("date")).agg(
        F.max(F.when(is_high & here, F.col("value"))).alias("own_high"),
        F.max(F.when(~is_high & here, F.col("value"))).alias("own_low"),
        F.max(F.when(~is_high, F.col("value"))).alias("largest_low"),
        F.min(F.when(is_high, F.col("value"))).alias("smallest_high"),
    )
    both = F.array(
        F.struct(F.lit(high).alias("element"), F.col("own_high").alias("value"), F.col("largest_low").alias("bound")),
        F.struct(F.lit(low).alias("element"), F.col("own_low").alias("value"), F.col("smallest_high").alias("bound")),
    )
    rows = met.select("id", "date", F.explode(both).alias("c")).select("id", "date", "c.*")
    apart = F.round((F.col("value") - F.col("bound")).cast("double"), 4)
    return rows.filter(F.when(F.col("element") == high, apart).otherwise(-apart) >= limit)


def record_extremes(daily: DataFrame, high: str = "TMAX", low: str = "TMIN") -> DataFrame:
    """(id, month, largest_high, smallest_low) over a station's whole record, by calendar month."""
    kept = _present(daily).filter(F.col("element").isin(high, low))
    return kept.groupBy("id", F.month("date").alias("month")).agg(
        F.max(F.when(F.col("element") == high, F.col("value"))).alias("largest_high"),
        F.min(F.when(F.col("element") == low, F.col("value"))).alias("smallest_low"),
    )


def beyond_record(daily: DataFrame, high: str = "TMAX", low: str = "TMIN") -> DataFrame:
    """(id, element, date, value, bound): values that contradict the other element's record.

    A ``high`` value below the smallest ``low`` value that the station ever had in the
    calendar month (``bound``), or a ``low`` value above the largest ``high`` value.
    Every row is judged, repeated ones too.

    The extremes are twelve rows a station; a station's months are joined with them, by
    broadcast where their counted size allows it, else with the rows of a station spread.
    """
    extremes = record_extremes(daily, high, low).withColumn("key", F.struct("id", "month"))
    rows = _present(daily).filter(F.col("element").isin(high, low))
    rows = rows.withColumn("key", F.struct(F.col("id"), F.month("date").alias("month")))
    joined = sized_join(rows, extremes.drop("id", "month"), "key", "inner", MASK_ROW_BYTES)
    is_high = F.col("element") == high
    bound = F.when(is_high, F.col("smallest_low")).otherwise(F.col("largest_high"))
    wrong = F.when(is_high, F.col("value") < bound).otherwise(F.col("value") > bound)
    return joined.filter(wrong).select("id", "element", "date", "value", bound.alias("bound"))


def copied_months(
    monthly_long: DataFrame,
    stations: DataFrame,
    since: int = COPIES_SINCE,
    change: float = REGION_CHANGE,
    share: float = REGION_SHARE,
    count: int = NEIGHBOURS,
    within_km: float = WITHIN_KM,
) -> DataFrame:
    """(id, dataset, element, date, value, n_neighbours, n_changed): months that look copied.

    A value of the year ``since`` or later that equals the one of the month before,
    while of the ``count`` nearest stations within ``within_km`` that have both months at
    least the part ``share`` changed by ``change`` or more. Without such a station the
    value is not judged. Rows that repeat a station, dataset, element and date are one,
    with the largest value. ``stations`` has id, lat and lon.
    """
    date = F.trunc("date", "MM")
    shifted = {"own": date, "before": F.add_months(date, 1)}
    pairs = _with_around(_present(monthly_long), shifted, list(SERIES))
    pairs = pairs.filter(F.col("own").isNotNull() & F.col("before").isNotNull() & (F.year("date") >= since))
    pairs, path = stored(pairs, "month-pairs")
    try:
        near = nearest_stations(stations, count, within_km).select("id", "neighbour")
        equal = pairs.filter(F.col("own") == F.col("before")).drop("before").join(near, "id")
        moved = F.round(F.abs(F.col("own") - F.col("before")).cast("double"), 4) >= change
        others = pairs.select(F.col("id").alias("neighbour"), "dataset", "element", "date", moved.alias("moved"))
        votes = equal.join(others, ["neighbour", "dataset", "element", "date"]).groupBy(*SERIES, "date")
        votes = votes.agg(
            F.first("own").alias("value"),
            F.count("*").alias("n_neighbours"),
            F.count_if("moved").alias("n_changed"),
        )
        return materialise(votes.filter(F.col("n_changed") >= share * F.col("n_neighbours")), "copied")
    finally:
        remove(pairs.sparkSession, path)


def mask_adjusted(
    monthly_long: DataFrame,
    unadjusted: str = "RAW",
    adjusted: str = "FLS52",
    flag: str = "qcflag",
    mark: str = "M",
    budget: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows, with the quality flags of one dataset carried into another.

    Where the ``unadjusted`` dataset has a flag that is not blank, rows of the
    ``adjusted`` one for the same station, element and date lose their value and get
    ``mark``. Other rows and columns stay as they are; a null flag is a blank one, and
    null dates match nothing.
    """
    key = F.struct("id", "element", "date")
    flagged = monthly_long.filter((F.col("dataset") == unadjusted) & (F.coalesce(F.col(flag), F.lit("")) != ""))
    flagged = flagged.dropna(subset=["id", "element", "date"]).select(key.alias("_key")).distinct()
    flagged = flagged.withColumn("_masked", F.lit(True))
    rows = monthly_long.withColumn("_key", F.when(F.col("dataset") == adjusted, key))
    joined = sized_join(rows, flagged, "_key", "left", MASK_ROW_BYTES, budget)
    masked = F.col("_masked").isNotNull()
    changed = {"value": F.when(~masked, F.col("value")), flag: F.when(masked, F.lit(mark)).otherwise(F.col(flag))}
    return reduce(lambda df, c: df.withColumn(c, changed[c]), changed, joined).select(*monthly_long.columns)
