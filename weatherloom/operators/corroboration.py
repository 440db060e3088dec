"""Daily checks against stations nearby, against other elements, and against other months.

What is compared is first reduced to one row per station and day or month, with a partial
step. Few values are suspicious; only these are repeated for their neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, remove, stored
from .joins import sized_join
from .neighbours import NEIGHBOURS, WITHIN_KM, nearest_stations
from .outliers import CLIMATE_DAYS, CLIMATE_VALUES, with_climate

ANOMALY = 10.0
WITNESSES = 3
WITNESS_DAYS = 1
# an id with the ids of its neighbours in memory, generous
NEAR_ROW_BYTES = 512
WARM_NIGHT = 7.0
NAUGHTS = (0.0, -17.8)  # zero degrees Celsius and zero Fahrenheit
SAME_VALUES = 10
# a value's columns and their lists in the row of a year
LISTED = {"date": "dates", "value": "values", "anomaly": "anomalies"}


def _present(daily: DataFrame) -> DataFrame:
    return daily.filter(F.col("value").isNotNull() & F.col("date").isNotNull())


def daily_anomalies(
    daily: DataFrame, days: int = CLIMATE_DAYS, min_values: int = CLIMATE_VALUES
) -> DataFrame:
    """(id, element, date, value, anomaly): how far values are from their ``daily_climate``.

    Values whose time of the year has fewer than ``min_values`` values are left out, and
    so are missing values and dates and null ids and elements. Rows that repeat a
    station, element and date are one, with the largest value.
    """
    met = with_climate(daily, days).filter(F.col("n_values") >= min_values)
    anomaly = F.round(F.col("value").cast("double") - F.col("mean"), 4)
    return met.select("id", "element", "date", "value", anomaly.alias("anomaly"))


def uncorroborated(
    daily: DataFrame,
    stations: DataFrame,
    limit: float = ANOMALY,
    witnesses: int = WITNESSES,
    days: int = WITNESS_DAYS,
    count: int = NEIGHBOURS,
    within_km: float = WITHIN_KM,
    climate_days: int = CLIMATE_DAYS,
    min_values: int = CLIMATE_VALUES,
) -> DataFrame:
    """(id, element, date, value, anomaly, n_neighbours, best_anomaly): anomalies that no
    station nearby shares.

    A value whose anomaly (``daily_anomalies``) is at least ``limit`` from zero and, in
    its direction, at least ``limit`` beyond every anomaly of the same element that the
    ``count`` nearest stations within ``within_km`` have on the day or up to ``days``
    days before or after it. ``best_anomaly`` is the farthest of these in the value's
    direction (negative if all point the other way), ``n_neighbours`` the number of
    stations that have one; with fewer than ``witnesses`` a value is not judged.
    ``stations`` has id, lat and lon, one row for each id.

    The anomalies are stored once, a year of a station and element in one row; all but
    the result is removed at the end. Years with suspicious values meet the list of their
    neighbours by a join of counted size, which spreads the rows of one station where the
    lists are too many to broadcast, and then the same year of each neighbour. So a year
    asks a neighbour once, and only what lies on the days around goes on.
    """
    rows, path = stored(_years(daily_anomalies(daily, climate_days, min_values), limit, days), "anomalies")
    try:
        near = nearest_stations(stations, count, within_km)
        near = near.groupBy("id").agg(F.collect_list("neighbour").alias("near"))  # at most ``count``
        return materialise(_alone(rows, near, limit, witnesses, days), "uncorroborated")
    finally:
        remove(rows.sparkSession, path)


def _years(rows: DataFrame, limit: float, days: int) -> DataFrame:
    """(id, element, year, dates, anomalies, far_dates, far_values, far_anomalies): a row for a year.

    ``dates`` go on for ``days`` days before and after the year, the suspicious
    ``far_dates`` do not. A year has one value for each date, and ``daily_anomalies`` has
    brought its series together already.
    """
    reached = F.sequence(F.year(F.date_sub("date", days)), F.year(F.date_add("date", days)))
    rows = rows.select("*", F.explode(reached).alias("year"))
    far = (F.col("year") == F.year("date")) & (F.abs("anomaly") >= limit)
    listed = [F.collect_list(c).alias(name) for c, name in LISTED.items() if c != "value"]
    listed += [F.collect_list(F.when(far, F.col(c))).alias(f"far_{name}") for c, name in LISTED.items()]
    return rows.groupBy("id", "element", "year").agg(*listed)


def _alone(years: DataFrame, near: DataFrame, limit: float, witnesses: int, days: int) -> DataFrame:
    own = ["id", "element", "year", "far_dates", "far_values", "far_anomalies"]
    asked = sized_join(years.filter(F.size("far_dates") > 0).select(own), near, "id", "inner", NEAR_ROW_BYTES)
    asked = asked.select(*own, F.explode("near").alias("neighbour"))
    witness = years.select(F.col("id").alias("neighbour"), "element", "year", "dates", "anomalies")
    met = asked.join(witness.hint("merge"), ["neighbour", "element", "year"])
    met = met.select("*", F.posexplode("far_dates").alias("far_at", "date"))
    met = met.select("*", F.posexplode("dates").alias("at", "on")).filter(F.abs(F.datediff("on", "date")) <= days)
    met = met.select(
        "neighbour", "id", "element", "date",
        F.get("far_values", F.col("far_at")).alias("value"),
        F.get("far_anomalies", F.col("far_at")).alias("anomaly"),
        F.get("anomalies", F.col("at")).alias("other"),
    )
    first = [F.first(c).alias(c) for c in ("value", "anomaly")]
    best = F.max(F.col("other") * F.signum("anomaly")).alias("best_anomaly")
    each = met.groupBy("id", "element", "date", "neighbour").agg(*first, best)
    n_neighbours = F.count("*").cast("int").alias("n_neighbours")
    judged = each.groupBy("id", "element", "date").agg(*first, n_neighbours, F.max("best_anomaly").alias("best_anomaly"))
    beyond = F.round(F.abs("anomaly") - F.col("best_anomaly"), 4) >= limit
    return judged.filter(beyond & (F.col("n_neighbours") >= witnesses))


def snow_in_warmth(
    daily: DataFrame, warm: float = WARM_NIGHT, days: int = 1, snow: str = "SNOW", low: str = "TMIN"
) -> DataFrame:
    """(id, date, value, lowest): snowfall while it was too warm for it.

    A ``snow`` value above zero where the smallest ``low`` value (``lowest``) of the day
    and the ``days`` days on both sides is ``warm`` or more. One such value is enough;
    without any the snow is not judged. Rows that repeat a station, element and date are
    one, with the largest value; a null id is a station like others.

    Snow stays on its day and minima are repeated for the days around, so both meet in
    one grouping, across the borders of months too.
    """
    is_snow = F.col("element") == snow
    kept = _present(daily).filter((is_snow & (F.col("value") > 0)) | (F.col("element") == low))
    single = kept.groupBy("id", "date", "element").agg(F.max("value").alias("value"))
    reach = F.when(is_snow, F.lit(0)).otherwise(F.lit(days))
    spread = single.select("id", "element", "value", "date", F.explode(F.sequence(-reach, reach)).alias("step"))
    met = spread.groupBy("id", F.date_add("date", F.col("step")).alias("date")).agg(
        F.max(F.when(is_snow, F.col("value"))).alias("value"),
        F.min(F.when(~is_snow, F.col("value"))).alias("lowest"),
    )
    return met.filter(F.col("value").isNotNull() & (F.round(F.col("lowest").cast("double"), 4) >= warm))


def inconsistent_days(
    daily: DataFrame,
    high: str = "TMAX",
    low: str = "TMIN",
    snow: str = "SNOW",
    rain: str = "PRCP",
    naughts: tuple[float, ...] = NAUGHTS,
) -> DataFrame:
    """(id, date, rule, value, other): days whose elements contradict each other.

    ``maximum_below_minimum``: the ``high`` value is below the ``low`` one.
    ``snow_without_precipitation``: ``snow`` above zero, ``rain`` zero.
    ``naught``: both temperatures are the same one of ``naughts``, which is what an empty
    form gives. ``value`` and ``other`` are the two values in the order named. Both must
    be there. Rows that repeat a station, element and date are one, with the largest
    value; a null id is a station like others. One grouping by station and day.
    """
    kept = _present(daily).filter(F.col("element").isin(high, low, snow, rain))
    value_of = lambda name: F.max(F.when(F.col("element") == name, F.col("value")))
    elements = {"high": high, "low": low, "snow": snow, "rain": rain}
    days = kept.groupBy("id", "date").agg(*[value_of(name).alias(place) for place, name in elements.items()])

    def rule(name: str, broken: Column, value: str, other: str) -> Column:
        pair = F.struct(F.lit(name).alias("rule"), F.col(value).alias("value"), F.col(other).alias("other"))
        return F.when(broken, pair)

    rounded = F.round(F.col("high").cast("double"), 4)
    rules = [
        rule("maximum_below_minimum", F.col("high") < F.col("low"), "high", "low"),
        rule("snow_without_precipitation", (F.col("snow") > 0) & (F.col("rain") == 0), "snow", "rain"),
        rule("naught", (F.col("high") == F.col("low")) & rounded.isin(*naughts), "high", "low"),
    ]
    broken = days.select("id", "date", F.explode(F.array_compact(F.array(*rules))).alias("broken"))
    return broken.select("id", "date", "broken.*")


def duplicate_months(daily: DataFrame, min_values: int = SAME_VALUES) -> DataFrame:
    """(id, element, month, first_month, n_values): months that repeat an earlier one.

    A month (its first day) whose values equal those of an earlier month of the station
    and element on the same days, with no other day in either; ``first_month`` is the
    first of all equal ones. Months with fewer than ``min_values`` values, and those
    whose values are all the same (such as months without rain), are left out. Rows that
    repeat a station, element and date are one, with the largest value; a null id or
    element is a series like others.

    A month becomes one row with a slot for each of its 31 days, and equal rows meet by
    grouping them: no pairs of months, and a month's state never grows.
    """
    month = F.trunc("date", "MM").cast("date")
    slot = lambda day: F.max(F.when(F.dayofmonth("date") == day, F.col("value")))
    slots = [f"d{day:02d}" for day in range(1, 32)]
    months = _present(daily).groupBy("id", "element", month.alias("month")).agg(
        *[slot(day).alias(name) for day, name in enumerate(slots, 1)]
    )
    values = F.array_compact(F.array(*slots))
    months = months.withColumn("n_values", F.size(values))
    varied = (F.col("n_values") >= min_values) & (F.array_min(values) < F.array_max(values))
    equal = months.filter(varied).groupBy("id", "element", "n_values", *slots).agg(
        F.min("month").alias("first_month"), F.sort_array(F.collect_list("month")).alias("months")
    )
    copies = equal.filter(F.size("months") > 1)
    rows = copies.select("id", "element", F.explode("months").alias("month"), "first_month", "n_values")
    return rows.filter(F.col("month") > F.col("first_month"))
