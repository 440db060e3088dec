"""Checks along a station's days: multiday totals, streaks and frequent values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# total, number of days, daily element; of the daily format document
MULTIDAY_ELEMENTS = (("MDPR", "DAPR", "PRCP"), ("MDSF", "DASF", "SNOW"), ("MDEV", "DAEV", "EVAP"))
# a total over more days than this fails by its length alone
MOST_DAYS = 31
STREAK_DAYS = 20
FREQUENT_SHARE = 0.5
FREQUENT_VALUES = 10


def multiday_totals(
    daily: DataFrame,
    elements: tuple[tuple[str, str, str], ...] = MULTIDAY_ELEMENTS,
    most_days: int = MOST_DAYS,
) -> DataFrame:
    """(id, element, date, value, days, first_date, n_observed, n_shared, failed) of each total.

    A multiday total stands on the last of its ``days`` days. It fails if the number of
    days is missing, below 2, no whole number or above ``most_days``; if one of the days
    from the first to the last has a value of its own (``n_observed`` of them); or if
    another total of the element covers one of them (``n_shared``). The counts are null
    where the length fails. Rows that repeat a station, element and date are one, with
    the largest value. A number of days without a total is no total.

    Intervals meet by their days, not by comparing them: a total is repeated for each
    of at most ``most_days`` days, and days meet on station, element and date.
    """
    kind = F.lit(None).cast("string")
    part = F.lit(None).cast("string")
    for total, length, single in elements:
        for name, role in ((total, "total"), (length, "days"), (single, "own")):
            kind = F.when(F.col("element") == name, total).otherwise(kind)
            part = F.when(F.col("element") == name, role).otherwise(part)
    present = daily.filter(F.col("value").isNotNull() & F.col("date").isNotNull())
    by_date = (
        present.select("id", "date", kind.alias("total"), part.alias("part"), "value")
        .filter(F.col("total").isNotNull())
        .groupBy("id", "total", "date")
        .agg(
            *[
                F.max(F.when(F.col("part") == name, F.col("value"))).alias(alias)
                for name, alias in (("own", "own"), ("total", "amount"), ("days", "days"))
            ]
        )
    )
    whole = F.col("days").between(2, most_days) & (F.col("days") == F.floor("days"))
    ends = F.col("amount").isNotNull()
    length = F.when(ends & whole, F.col("days").cast("int"))
    by_date = by_date.withColumn("length", length)
    # every row speaks for its own date, a total for the days before it too
    back = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("length"), F.lit(1)) - 1)).alias("back")
    spread = by_date.select(
        "id", "total", F.col("date").alias("end"), "own", "amount", "days", "length", back
    ).withColumn("date", F.date_sub("end", F.col("back")))
    here = Window.partitionBy("id", "total", "date")
    covered = F.count(F.when(F.col("length").isNotNull(), 1)).over(here)
    observed = F.max(F.when((F.col("back") == 0) & F.col("own").isNotNull(), 1).otherwise(0)).over(here)
    met = spread.withColumn("covered", covered).withColumn("observed", observed).filter(F.col("amount").isNotNull())
    totals = met.groupBy("id", F.col("total").alias("element"), F.col("end").alias("date")).agg(
        F.first("amount").alias("value"),
        F.first("days").alias("days"),
        F.min(F.when(F.col("length").isNotNull(), F.col("date"))).alias("first_date"),
        F.sum(F.when(F.col("length").isNotNull(), F.col("observed"))).alias("n_observed"),
        F.sum(F.when(F.col("length").isNotNull(), (F.col("covered") > 1).cast("int"))).alias("n_shared"),
    )
    failed = F.col("n_observed").isNull() | (F.col("n_observed") > 0) | (F.col("n_shared") > 0)
    return totals.withColumn("failed", failed)


def spread_totals(totals: DataFrame, elements: tuple[tuple[str, str, str], ...] = MULTIDAY_ELEMENTS) -> DataFrame:
    """(id, element, date, value) for every day of each total that did not fail.

    The days share the amount equally and have the daily element's name. ``totals`` is
    the result of ``multiday_totals``.
    """
    single = F.lit(None).cast("string")
    for total, _, own in elements:
        single = F.when(F.col("element") == total, own).otherwise(single)
    day = F.explode(F.sequence(F.col("first_date"), F.col("date"))).alias("day")
    share = (F.col("value").cast("double") / F.col("days")).cast("float")
    kept = totals.filter(~F.col("failed"))
    return kept.select("id", single.alias("element"), share.alias("value"), day).select(
        "id", "element", F.col("day").alias("date"), "value"
    )


def streaks(
    daily: DataFrame, min_values: int = STREAK_DAYS, leave_out: float | None = None
) -> DataFrame:
    """(id, element, value, first_date, last_date, n_values): equal values in a row.

    Consecutive values of a station and element, missing days passed over, that are
    equal; streaks of at least ``min_values`` values. Values equal to ``leave_out``
    (zero for precipitation) are passed over like missing ones. Rows that repeat a date
    are one, with the largest value.

    Series are cut by year, so a window sort sees at most 366 rows however long a record
    is. Only the first and the last run of a year can go on in another one: at most two
    rows a year meet in a second window over the whole series, the others are final.
    """
    present = daily.filter(F.col("value").isNotNull() & F.col("date").isNotNull())
    if leave_out is not None:
        present = present.filter(F.col("value") != F.lit(leave_out).cast("float"))
    days = present.groupBy("id", "element", F.year("date").alias("year"), "date").agg(F.max("value").alias("value"))
    year = ["id", "element", "year"]
    order = Window.partitionBy(*year).orderBy("date")
    changed = (F.lag("value").over(order).isNull() | (F.lag("value").over(order) != F.col("value"))).cast("int")
    numbered = days.withColumn("changed", changed).withColumn("run", F.sum("changed").over(order))
    numbered = numbered.withColumn("runs", F.max("run").over(Window.partitionBy(*year)))
    runs = numbered.groupBy(*year, "run", "runs", "value").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n_values")
    )
    at_edge = (F.col("run") == 1) | (F.col("run") == F.col("runs"))
    columns = ["id", "element", "value", "first_date", "last_date", "n_values"]
    final = runs.filter(~at_edge).select(*columns)
    return final.unionByName(_across_years(runs.filter(at_edge))).filter(F.col("n_values") >= min_values)


def _across_years(edges: DataFrame) -> DataFrame:
    """Edge runs of years, joined where one goes on in the next.

    Only the first run of a year can go on from the row before it, which is the last run
    of the year before. The row before a last run is the first run of the same year: it
    has another value, or other runs lie between.
    """
    order = Window.partitionBy("id", "element").orderBy("first_date")
    goes_on = (F.col("run") == 1) & (F.lag("value").over(order) == F.col("value"))
    starts = F.when(goes_on, 0).otherwise(1)
    numbered = edges.withColumn("starts", starts).withColumn("streak", F.sum("starts").over(order))
    return numbered.groupBy("id", "element", "streak", "value").agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.sum("n_values").alias("n_values")
    ).drop("streak")


def frequent_values(
    daily: DataFrame,
    share: float = FREQUENT_SHARE,
    min_values: int = FREQUENT_VALUES,
    leave_out: float | None = None,
) -> DataFrame:
    """(id, element, month, value, n_values, n_all): values that are too common.

    Within a station, element and calendar month of all years, a value that makes up at
    least ``share`` of at least ``min_values`` values. ``leave_out`` as in ``streaks``.
    The window sees distinct values with their counts only.
    """
    present = daily.filter(F.col("value").isNotNull() & F.col("date").isNotNull())
    if leave_out is not None:
        present = present.filter(F.col("value") != F.lit(leave_out).cast("float"))
    days = present.groupBy("id", "element", "date").agg(F.max("value").alias("value"))
    group = ["id", "element", "month"]
    counts = days.groupBy("id", "element", F.month("date").alias("month"), "value").agg(F.count("*").alias("n_values"))
    counts = counts.withColumn("n_all", F.sum("n_values").over(Window.partitionBy(*group)))
    return counts.filter((F.col("n_all") >= min_values) & (F.col("n_values") >= share * F.col("n_all")))
