"""Complete runs: archives of text to dated Parquet tables."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.layouts import CORE_ELEMENTS, MONTHLY, StationLayout
from ..operators.joins import inject_coords, station_lookup
from ..operators.reshape import to_daily_long, to_monthly_sparse
from ..session import materialise, remove, stored
from ..sources.archives import unpack_archives
from ..sources.readings import (
    Scan,
    parse_monthly,
    scan_daily,
    scan_monthly,
    split_bad_records,
)
from ..sources.snapshots import write_daily, write_monthly, write_stations
from ..sources.stations import parse_stations, rejected_stations, station_lines


class Run(NamedTuple):
    """Where a run wrote, how many readings it kept, and what it rejected."""

    path: str
    readings: dict[str, int]
    rejects: DataFrame


class Stations(NamedTuple):
    """Where a station list was written, its lookup, and the lines it rejected."""

    path: str
    lookup: DataFrame
    rejects: DataFrame


def _counted(readings: DataFrame, datasets: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Count located readings per dataset while they flow to the sink.

    After the coordinate join, which keeps the number of rows, the counters run
    in the stage that writes, where every task counts once.
    """
    observation = Observation()
    counters = [F.count_if(F.col("dataset") == name).alias(name) for name in datasets]
    return readings.observe(observation, *counters), observation


def run_stations(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: StationLayout | str,
    base: str,
    snapshot_date: datetime.date | str,
) -> Stations:
    """Station lists to Parquet. The list is read once; the coordinate lookup is
    stored for the runs that join it."""
    lines = station_lines(spark, paths)
    stations = materialise(parse_stations(lines, layout), "stations")
    network = layout if isinstance(layout, str) else layout.name
    path = write_stations(stations, base, network, snapshot_date)
    lookup = materialise(station_lookup(stations), "station-lookup")
    return Stations(path, lookup, rejected_stations(lines, layout))


def run_daily(
    spark: SparkSession,
    paths: str | Sequence[str],
    lookup: DataFrame,
    base: str,
    snapshot_date: datetime.date | str,
    elements: Sequence[str] | None = CORE_ELEMENTS,
    bad_records: str = "quarantine",
) -> Run:
    """Daily text to the long Parquet table: one stage, no shuffle.

    Rows are clustered by element and month, so that row groups have narrow
    ranges for element and date filters.
    """
    scan = scan_daily(spark, paths, elements, bad_records)
    located, counts = _counted(inject_coords(scan.readings, lookup), ["UNKNOWN"])
    long = to_daily_long(located, cluster=True)
    path = write_daily(long, base, snapshot_date)
    return Run(path, counts.get, scan.rejects)


def _run_monthly(
    scan: Scan, lookup: DataFrame, base: str, snapshot_date: datetime.date | str
) -> Run:
    located, counts = _counted(
        inject_coords(scan.readings, lookup), ["RAW", "TOB", "FLS52", "UNKNOWN"]
    )
    sparse = to_monthly_sparse(located, keep_dataset=True)
    path = write_monthly(sparse, base, snapshot_date)
    return Run(path, counts.get, scan.rejects)


def run_monthly(
    spark: SparkSession,
    paths: str | Sequence[str],
    lookup: DataFrame,
    base: str,
    snapshot_date: datetime.date | str,
    bad_records: str = "quarantine",
) -> Run:
    """Monthly text to one sparse Parquet table per dataset: one stage."""
    return _run_monthly(scan_monthly(spark, paths, bad_records), lookup, base, snapshot_date)


def run_monthly_archives(
    archives: DataFrame,
    lookup: DataFrame,
    base: str,
    snapshot_date: datetime.date | str,
    bad_records: str = "quarantine",
) -> Run:
    """Monthly archives to one sparse Parquet table per dataset.

    The lines are unpacked once, to a table that many tasks can read; only
    decompression is bound to one task per archive. Every member is read: lines
    that are no records, such as those of a station list, are among the rejects,
    which are stored before the unpacked lines are removed.
    """
    spark = archives.sparkSession
    lines, path = stored(unpack_archives(archives), "archive-lines")
    lines = lines.select("file_name", "line")
    scan = split_bad_records(lines, parse_monthly(lines), MONTHLY, bad_records)
    run = _run_monthly(scan, lookup, base, snapshot_date)
    rejects = materialise(run.rejects, "rejects")
    remove(spark, path)
    return run._replace(rejects=rejects)
