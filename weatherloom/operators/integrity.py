"""Integrity rules, all evaluated in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reshape import MEASURES

# --- fixed values -----------------------------------------------------------
TEMPERATURE_RANGE = (-50.0, 60.0)
DAILY_LAT_RANGE, DAILY_LON_RANGE = (18.0, 71.0), (-178.0, -65.0)
MONTHLY_LAT_RANGE, MONTHLY_LON_RANGE = (21.0, 69.0), (-158.0, -65.0)
DAILY_REQUIRED = ("id", "date", "element", "dataset", "value")
MONTHLY_REQUIRED = ("id",)
STATION_REQUIRED = ("country_code", "network_code", "id_placeholder", "coop_id", "name")
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A named check: which rows it looks at and which of them break it."""

    name: str
    checked: Column
    violated: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column} is present", F.lit(True), F.col(column).isNull())


def in_range(column: str, low: float, high: float) -> Rule:
    """Nulls are skipped, not violations."""
    present = F.col(column).isNotNull()
    return Rule(
        f"{column} in [{low:g}, {high:g}]", present, present & ~F.col(column).between(low, high)
    )


def first_of_month(column: str = "date") -> Rule:
    present = F.col(column).isNotNull()
    return Rule(f"{column} is the first of a month", present, F.dayofmonth(column) != 1)


def required(columns: Sequence[str]) -> list[Rule]:
    return [not_null(column) for column in columns]


def temperature_rules(columns: Sequence[str] = MEASURES) -> list[Rule]:
    return [in_range(column, *TEMPERATURE_RANGE) for column in columns]


def daily_rules() -> list[Rule]:
    """Rules of the daily table. The range applies to temperatures only."""
    is_temperature = F.col("element").isin("TMAX", "TMIN")
    low, high = TEMPERATURE_RANGE
    return [
        *required(DAILY_REQUIRED),
        not_null("lat"),
        Rule(
            f"temperature in [{low:g}, {high:g}]",
            is_temperature,
            is_temperature & ~F.col("value").between(low, high),
        ),
        in_range("lat", *DAILY_LAT_RANGE),
        in_range("lon", *DAILY_LON_RANGE),
    ]


def monthly_rules() -> list[Rule]:
    return [
        *required(MONTHLY_REQUIRED),
        not_null("lat"),
        *temperature_rules(),
        first_of_month(),
        in_range("lat", *MONTHLY_LAT_RANGE),
        in_range("lon", *MONTHLY_LON_RANGE),
    ]


def station_rules() -> list[Rule]:
    return required(STATION_REQUIRED)


def check_integrity(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One (rule, checked, violations) row per rule.

    All counters are one global aggregate with a partial step; turning its
    single row into rows afterwards costs nothing.
    """
    counters = []
    for i, rule in enumerate(rules):
        counters.append(F.count_if(rule.checked).alias(f"checked_{i}"))
        counters.append(F.count_if(rule.violated).alias(f"violations_{i}"))
    entries = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"checked_{i}").alias("checked"),
            F.col(f"violations_{i}").alias("violations"),
        )
        for i, rule in enumerate(rules)
    ]
    return df.agg(*counters).select(F.inline(F.array(*entries)))
