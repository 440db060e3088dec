"""Statistical checks of station values described in the archive format documents.

Values are reduced to one per station and day or month first, with a partial step, so
what a window or a second aggregate sees of a station is bounded by the calendar or by
the resolution of the values, however often rows repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, remove, stored
from .neighbours import NEIGHBOURS, WITHIN_KM, nearest_stations

SERIES = ("id", "dataset", "element")
# deviations, in median deviations, from which a value has no weight
BIWEIGHT_REACH = 7.5
# fewer values of a calendar month say nothing about its spread
MONTHLY_VALUES = 5
OUTLIER_SCORE = 5.0
# fixed values: a target score from the first number on needs a neighbour's score of the second
WITNESS_SCORES = ((2.5, 1.6), (2.75, 1.7), (3.0, 1.8), (4.0, 1.9))
CLIMATE_DAYS = 7
CLIMATE_VALUES = 100
CLIMATE_SCORE = 6.0
GAP = 10.0


def _one_per_date(long: DataFrame, *series: str) -> DataFrame:
    """One value per series and date: the largest of repeated ones; no missing ones."""
    present = long.filter(F.col("value").isNotNull() & F.col("date").isNotNull())
    return present.groupBy(*series, "date").agg(F.max("value").alias("value"))


def biweight_scores(
    monthly_long: DataFrame, reach: float = BIWEIGHT_REACH, min_values: int = MONTHLY_VALUES
) -> DataFrame:
    """(id, dataset, element, date, value, n_values, mean, deviation, score) of each value.

    Mean and standard deviation are the biweight estimates over all values of the
    station, dataset and element in the same calendar month: with the median m and the
    median absolute deviation d, a value weighs by u = (x - m) / (reach * d) and nothing
    where |u| >= 1; mean = m + sum((x - m)(1 - u^2)^2) / sum((1 - u^2)^2), deviation =
    sqrt(n sum((x - m)^2 (1 - u^2)^4)) / |sum((1 - u^2)(1 - 5 u^2))|. The score is
    (x - mean) / deviation.

    Months with fewer than ``min_values`` values, or where half of the values are equal
    (d = 0), have no deviation and no score. Repeated rows count once. Null values and
    dates are left out; a null id, dataset or element is a series like others.

    One shuffle brings the values of a calendar month together, at most one for each
    year; all steps are windows over this one partitioning.
    """
    cells = _one_per_date(monthly_long, *SERIES).withColumn("x", F.col("value").cast("double"))
    month = Window.partitionBy(*SERIES, F.month("date"))
    median = lambda c: F.percentile(c, F.lit(0.5)).over(month)
    cells = cells.withColumn("n_values", F.count("x").over(month)).withColumn("m", median(F.col("x")))
    cells = cells.withColumn("d", median(F.abs(F.col("x") - F.col("m"))))
    u = F.when((F.col("d") > 0) & (F.col("n_values") >= min_values), (F.col("x") - F.col("m")) / (reach * F.col("d")))
    cells = cells.withColumn("u2", u * u)
    inside = lambda c: F.sum(F.when(F.col("u2") < 1, c)).over(month)
    off, rest = F.col("x") - F.col("m"), 1 - F.col("u2")
    mean = F.col("m") + inside(off * rest**2) / inside(rest**2)
    around = F.sqrt(F.col("n_values") * inside(off**2 * rest**4))
    spread = F.try_divide(around, F.abs(inside(rest * (1 - 5 * F.col("u2")))))
    cells = cells.withColumn("mean", mean).withColumn("deviation", spread)
    score = F.try_divide(F.col("x") - F.col("mean"), F.col("deviation"))
    return cells.select(*SERIES, "date", "value", "n_values", "mean", "deviation", score.alias("score"))


def biweight_outliers(
    monthly_long: DataFrame,
    limit: float = OUTLIER_SCORE,
    reach: float = BIWEIGHT_REACH,
    min_values: int = MONTHLY_VALUES,
) -> DataFrame:
    """The values at least ``limit`` biweight deviations from the biweight mean, with
    the columns of ``biweight_scores``."""
    return biweight_scores(monthly_long, reach, min_values).filter(F.abs("score") >= limit)


def _witness_score(score: Column, table: tuple[tuple[float, float], ...]) -> Column:
    needed = F.lit(None).cast("double")
    for start, least in table:
        needed = F.when(score >= start, F.lit(least)).otherwise(needed)
    return needed


def spatial_outliers(
    monthly_long: DataFrame,
    stations: DataFrame,
    count: int = NEIGHBOURS,
    within_km: float = WITHIN_KM,
    limit: float = OUTLIER_SCORE,
    table: tuple[tuple[float, float], ...] = WITNESS_SCORES,
    reach: float = BIWEIGHT_REACH,
    min_values: int = MONTHLY_VALUES,
) -> DataFrame:
    """(id, dataset, element, date, value, score, n_neighbours, best_score): values that
    no neighbour confirms.

    A value with an absolute biweight score from the first number of ``table`` up to
    ``limit`` needs one of the ``count`` nearest stations within ``within_km`` whose
    score for the same dataset, element and month has the same sign and is at least as
    far from zero as ``table`` says for the value's score. ``best_score`` is the
    farthest neighbour's score in the value's direction (negative if all point the
    other way), ``n_neighbours`` how many have a score. A value without any such
    neighbour cannot be judged and is not returned. ``stations`` has id, lat and lon.

    The scores are stored once; all but the result is removed at the end. Few values are
    suspicious; only these are repeated for their neighbours, and meet the scores in one
    join on station, dataset, element and date, a key of one row.
    """
    scores = biweight_scores(monthly_long, reach, min_values).filter(F.col("score").isNotNull())
    scores, path = stored(scores.select(*SERIES, "date", "value", "score"), "scores")
    try:
        near = nearest_stations(stations, count, within_km).select("id", "neighbour")
        return materialise(_unconfirmed(scores, near, limit, table), "spatial")
    finally:
        remove(scores.sparkSession, path)


def _unconfirmed(
    scores: DataFrame, near: DataFrame, limit: float, table: tuple[tuple[float, float], ...]
) -> DataFrame:
    far = F.abs("score")
    suspects = scores.filter((far >= min(start for start, _ in table)) & (far < limit))
    asked = suspects.join(near, "id")
    witness = scores.select(
        F.col("id").alias("neighbour"), "dataset", "element", "date", F.col("score").alias("other")
    )
    met = asked.join(witness, ["neighbour", "dataset", "element", "date"])
    judged = met.groupBy(*SERIES, "date").agg(
        F.first("value").alias("value"),
        F.first("score").alias("score"),
        F.count("other").alias("n_neighbours"),
        F.max(F.col("other") * F.signum("score")).alias("best_score"),
    )
    return judged.filter(F.col("best_score") < _witness_score(F.abs("score"), table))


def day_of_year(date: Column) -> Column:
    """1 to 366, the same number for a date in every year: 29 February is 60."""
    return F.dayofyear(F.make_date(F.lit(2000), F.month(date), F.dayofmonth(date)))


YEAR = 366


def _day_sums(own: DataFrame) -> DataFrame:
    """(id, element, day, n, s, q): count, sum and sum of squares of the tenths of single days."""
    tenths = F.round(F.col("value").cast("double") * 10).cast("long")
    return own.groupBy("id", "element", day_of_year(F.col("date")).alias("day")).agg(
        F.count("*").alias("n"), F.sum(tenths).alias("s"), F.sum(tenths * tenths).alias("q")
    )


def _turns(single: DataFrame, days: int) -> DataFrame:
    """(id, element, at, n, s, q): what the sums around a day of the year gain or lose at ``at``.

    A day counts from ``days`` before it to ``days`` after it, an arc that goes on at the
    other end of the year: two rows, or four at the turn, however wide the arc is.
    """
    begin, end = F.col("day") - days, F.col("day") + days
    first_lap, last_lap = F.floor((begin - 1) / YEAR), F.floor((end - 1) / YEAR)
    arcs = single.withColumn("lap", F.explode(F.sequence(first_lap, last_lap)))
    begin = F.greatest(begin - F.col("lap") * YEAR, F.lit(1)).cast("int")
    end = F.least(end - F.col("lap") * YEAR, F.lit(YEAR)).cast("int")
    turns = F.array(
        F.struct(begin.alias("at"), *(F.col(c).alias(c) for c in "nsq")),
        F.struct((end + 1).alias("at"), *((-F.col(c)).alias(c) for c in "nsq")),
    )
    return arcs.select("id", "element", F.explode(turns).alias("turn")).select("id", "element", "turn.*")


def _around() -> tuple[Column, Column, Column]:
    """n_values, mean and deviation of the running sums of ``_turns``.

    A series has at most four rows for each day of the year, and its dates.
    """
    so_far = Window.partitionBy("id", "element").orderBy("at")
    n_values, total, squares = (F.sum(c).over(so_far) for c in "nsq")
    n, s, q = (c.cast("double") for c in (n_values, total, squares))
    spread = F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0))) / 10
    return n_values, F.when(n > 0, s / n / 10), F.when(n > 1, spread)


def daily_climate(daily: DataFrame, days: int = CLIMATE_DAYS) -> DataFrame:
    """(id, element, day, n_values, mean, deviation) for each day of the year.

    Over the values of all years on the day and ``days`` days on both sides, around the
    turn of the year too; a single value has no deviation. Values are counted and summed
    for each single day first. What a day adds to the days around it is a gain where its
    arc begins and a loss behind its end; running sums over these few rows hold from one
    to the next, and only the result is repeated for the days between. Sums are of whole
    tenths, so they are exact in any order.
    """
    turns = _turns(_day_sums(_one_per_date(daily, "id", "element")), days)
    n_values, mean, deviation = _around()
    next_at = F.lead("at").over(Window.partitionBy("id", "element").orderBy("at"))
    steps = turns.repartition("id", "element").select(
        "id", "element", "at", next_at.alias("next_at"),
        n_values.alias("n_values"), mean.alias("mean"), deviation.alias("deviation"),
    )
    steps = steps.filter((F.col("n_values") > 0) & (F.col("next_at") > F.col("at")))
    day = F.explode(F.sequence(F.col("at"), F.col("next_at") - 1)).alias("day")
    return steps.select("id", "element", day, "n_values", "mean", "deviation")


def with_climate(daily: DataFrame, days: int = CLIMATE_DAYS) -> DataFrame:
    """(id, element, date, value, n_values, mean, deviation): values with their ``daily_climate``.

    One row per station, element and date, with the largest value; null ids and elements
    are left out. The values stand among the gains and losses of their series and take
    the running sums there, so no climate is written out and joined.
    """
    own = _one_per_date(daily, "id", "element").filter(F.col("id").isNotNull() & F.col("element").isNotNull())
    turns = _turns(_day_sums(own), days).select(
        "id", "element", "at", "n", "s", "q", F.lit(None).cast("date").alias("date"),
        F.lit(None).cast(own.schema["value"].dataType).alias("value"),
    )
    zero = [F.lit(0).cast("long").alias(c) for c in "nsq"]
    values = own.select("id", "element", day_of_year(F.col("date")).alias("at"), *zero, "date", "value")
    n_values, mean, deviation = _around()
    met = turns.unionByName(values).repartition("id", "element").select(
        "id", "element", "date", "value", n_values.alias("n_values"), mean.alias("mean"), deviation.alias("deviation")
    )
    return met.filter(F.col("date").isNotNull())


def climate_outliers(
    daily: DataFrame,
    days: int = CLIMATE_DAYS,
    limit: float = CLIMATE_SCORE,
    min_values: int = CLIMATE_VALUES,
) -> DataFrame:
    """(id, element, date, value, n_values, mean, deviation, score): values at least
    ``limit`` standard deviations from the mean of their time of the year.

    The climate of a day needs ``min_values`` values and a deviation. Repeated rows of a
    station, element and date count once, with their largest value.
    """
    met = with_climate(daily, days).filter((F.col("n_values") >= min_values) & (F.col("deviation") > 0))
    score = (F.col("value").cast("double") - F.col("mean")) / F.col("deviation")
    return met.withColumn("score", score).filter(F.abs("score") >= limit)


def value_gaps(daily: DataFrame, gap: float = GAP) -> DataFrame:
    """(id, element, month, low_end, high_start): where the values of a calendar month end.

    From the median of all values of a station, element and calendar month outwards,
    ``high_start`` is the first value at least ``gap`` above the next smaller one, and
    ``low_end`` the first at least ``gap`` below the next larger one; null without a
    gap. The median is the smallest value that at least half of the values do not
    exceed. Repeated rows count once.

    Works on counts of distinct values, of which the resolution of the readings allows
    few; a window never sees the values themselves.
    """
    counts = (
        _one_per_date(daily, "id", "element")
        .groupBy("id", "element", F.month("date").alias("month"), "value")
        .agg(F.count("*").alias("n"))
    )
    group = ["id", "element", "month"]
    rising = Window.partitionBy(*group).orderBy("value")
    whole = Window.partitionBy(*group)
    counts = counts.withColumn("so_far", F.sum("n").over(rising)).withColumn("all", F.sum("n").over(whole))
    counts = counts.withColumn("before", F.lag("value").over(rising)).withColumn("after", F.lead("value").over(rising))
    middle = F.min(F.when(2 * F.col("so_far") >= F.col("all"), F.col("value"))).over(whole)
    counts = counts.withColumn("middle", middle)
    wide = lambda a, b: F.round((a - b).cast("double"), 4) >= gap
    value = F.col("value")
    high = F.when((value > F.col("middle")) & wide(value, F.col("before")), value)
    low = F.when((value < F.col("middle")) & wide(F.col("after"), value), value)
    found = counts.groupBy(*group).agg(F.max(low).alias("low_end"), F.min(high).alias("high_start"))
    return found.filter(F.col("low_end").isNotNull() | F.col("high_start").isNotNull())


def gap_outliers(daily: DataFrame, gap: float = GAP) -> DataFrame:
    """(id, element, date, value, low_end, high_start): values beyond a gap.

    See ``value_gaps``. Repeated rows of a date count once, with their largest value.
    """
    gaps = value_gaps(daily, gap)
    own = _one_per_date(daily, "id", "element").withColumn("month", F.month("date"))
    rows = own.join(gaps, ["id", "element", "month"])
    beyond = (F.col("value") <= F.col("low_end")) | (F.col("value") >= F.col("high_start"))
    return rows.filter(beyond).select("id", "element", "date", "value", "low_end", "high_start")
