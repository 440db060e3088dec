"""Lines to readings: the daily and the monthly record.

A reading keeps the bytes of its line in ``raw`` (plus their count in
``length``) until the reshaping operators cut the single values out of it.
That keeps a reading one narrow row through filters and the coordinate join,
and avoids building an array that is exploded right away.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (
    UNSIGNED,
    cut,
    element_properties,
    file_properties,
    lenient_int,
    line_bytes,
    line_length,
    slot_values,
    unsigned_int,
)
from ..functions.layouts import CORE_ELEMENTS, DAILY, MONTHLY, SlotLayout
from ..operators.joins import exclude_files
from .text import list_files, read_lines

# Names of monthly data files, for callers that choose by name: three-part names
# of the raw and tob sets, and four-part names.
MONTHLY_FILE_PATTERN = "{*.raw.*,*.tob.*,*.*.*.*}"


class Scan(NamedTuple):
    """Readings and what was turned away."""

    readings: DataFrame
    rejects: DataFrame


def is_record(raw: Column, layout: SlotLayout) -> Column:
    """True for a line of ``layout``: long enough, and dated.

    One pattern covers year and month where they are neighbours, so that a good
    line costs a single match.
    """
    start, end = layout.year
    pattern = UNSIGNED[4]
    if layout.month:
        end = layout.month[1]
        pattern += UNSIGNED[2]
    dated = cut(raw, (start, end)).rlike(f"^{pattern}$")
    return (line_length(raw) >= layout.min_length) & dated


def reject_reason(raw: Column, layout: SlotLayout) -> Column:
    """Why a line is not a record of ``layout``."""
    reason = F.when(line_length(raw) < layout.min_length, "short line")
    reason = reason.when(unsigned_int(cut(raw, layout.year), 4).isNull(), "bad year")
    return reason.otherwise("bad month") if layout.month else reason


def _passed_through(lines: DataFrame) -> list[str]:
    return [name for name in lines.columns if name != "line"]


def parse_daily(
    lines: DataFrame, elements: Sequence[str] | None = CORE_ELEMENTS
) -> DataFrame:
    """Good daily lines as readings; ``elements=None`` keeps every element.

    The element test is a plain filter on a slice of the line, so lines of
    other elements are dropped before anything else is parsed.
    """
    raw = F.col("raw")
    df = lines.withColumn("raw", line_bytes(F.col("line")))
    if elements is not None:
        df = df.filter(F.upper(cut(raw, DAILY.element)).isin(*elements))
    if elements is None:
        properties = [
            F.lit("UNKNOWN").alias("dataset"),
            F.upper(cut(raw, DAILY.element)).alias("element"),
        ]
    else:
        properties = element_properties(cut(raw, DAILY.element), tuple(elements))
    return df.filter(is_record(raw, DAILY)).select(
        *_passed_through(lines),
        cut(raw, DAILY.id).alias("id"),
        lenient_int(cut(raw, DAILY.year)).alias("year"),
        lenient_int(cut(raw, DAILY.month)).alias("month"),
        *properties,
        line_length(raw).alias("length"),
        "raw",
    )


def parse_monthly(lines: DataFrame) -> DataFrame:
    """Good monthly lines as readings; the file name gives dataset and element."""
    raw = F.col("raw")
    return (
        lines.withColumn("raw", line_bytes(F.col("line")))
        .filter(is_record(raw, MONTHLY))
        .select(
            *_passed_through(lines),
            cut(raw, MONTHLY.id).alias("id"),
            lenient_int(cut(raw, MONTHLY.year)).alias("year"),
            *file_properties(F.col("file_name")),
            line_length(raw).alias("length"),
            "raw",
        )
    )


def rejected_lines(lines: DataFrame, layout: SlotLayout) -> DataFrame:
    """The lines that are not records, with the reason."""
    raw = line_bytes(F.col("line"))
    return lines.filter(~is_record(raw, layout)).withColumn("reason", reject_reason(raw, layout))


def rejected_files(lines: DataFrame, layout: SlotLayout) -> DataFrame:
    """Files holding at least one bad line, with the number of bad lines."""
    return (
        rejected_lines(lines, layout)
        .groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("bad_lines"), F.min("reason").alias("reason"))
    )


def split_bad_records(
    lines: DataFrame, readings: DataFrame, layout: SlotLayout, bad_records: str
) -> Scan:
    """Apply a bad-record mode.

    ``quarantine`` sets bad lines aside and keeps the rest of the file in the
    same pass; ``drop_file`` lets one bad line turn the whole file away, which
    takes a second pass over the input.
    """
    if bad_records == "quarantine":
        return Scan(readings, rejected_lines(lines, layout))
    if bad_records == "drop_file":
        bad_files = rejected_files(lines, layout)
        return Scan(*exclude_files(readings, bad_files))
    raise ValueError(f"unknown bad_records mode: {bad_records}")


def scan_daily(
    spark: SparkSession,
    paths: str | Sequence[str],
    elements: Sequence[str] | None = CORE_ELEMENTS,
    bad_records: str = "quarantine",
    recursive: bool = False,
) -> Scan:
    """Daily readings of a directory of fixed-width files.

    Readings carry their file name only where it is needed, to drop files.
    """
    lines = read_lines(spark, paths, recursive=recursive)
    used = lines
    if bad_records != "drop_file":
        used = read_lines(spark, paths, recursive=recursive, with_file_name=False)
    return split_bad_records(lines, parse_daily(used, elements), DAILY, bad_records)


def scan_monthly(
    spark: SparkSession,
    paths: str | Sequence[str],
    bad_records: str = "quarantine",
    recursive: bool = False,
    pattern: str | None = None,
) -> Scan:
    """Monthly readings of a directory of fixed-width files.

    Every file is read and its lines decide: what is no record, such as a line of
    a station list, is among the rejects, and records of a file with an unknown
    name have an unknown dataset and element. ``pattern`` narrows the choice.
    """
    lines = read_lines(spark, paths, pattern=pattern, recursive=recursive)
    return split_bad_records(lines, parse_monthly(lines), MONTHLY, bad_records)


def unread_files(
    spark: SparkSession, path: str, pattern: str = MONTHLY_FILE_PATTERN
) -> DataFrame:
    """Files of a folder that a scan with this pattern leaves out."""
    matched = list_files(spark, path, pattern)
    return list_files(spark, path).join(matched, ["file_name", "path"], "left_anti")


def with_values(readings: DataFrame, layout: SlotLayout) -> DataFrame:
    """Readings with their values as an array instead of the line."""
    values = slot_values(F.col("raw"), F.col("length"), layout)
    return readings.withColumn("values", values).drop("raw", "length")
