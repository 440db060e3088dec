"""Dated Parquet output and its readers.

Layout below a base folder:

    daily/snapshot_date=2025-06-27/...
    monthly/snapshot_date=2025-06-27/dataset=raw/...
    stations/network=daily_network/snapshot_date=2025-06-27/...

Writing a snapshot twice replaces it. Snapshots are written to a fixed folder
name, so no writer needs a sort on the date.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import sink_label
from ..operators.reshape import DAILY_COLUMNS, MEASURES, MONTHLY_COLUMNS
from ..session import folder_names
from .stations import STATION_COLUMNS

# The tables' fixed schemas with their folder columns: reading needs no inference.
DAILY_SCHEMA = (
    "id string, date date, element string, dataset string, value float, lat float, lon float, "
    "snapshot_date date"
)
MONTHLY_SCHEMA = (
    "id string, date date, "
    + ", ".join(f"{name} float" for name in MEASURES)
    + ", lat float, lon float, snapshot_date date, dataset string"
)
STATION_SCHEMA = (
    "country_code string, network_code string, id_placeholder string, coop_id string, "
    "latitude float, longitude float, elevation float, state string, name string, "
    "network string, snapshot_date date"
)
# Upper limit of a file: a task that reads very much splits its output.
MAX_RECORDS_PER_FILE = 20_000_000


def _snapshot(base: str, kind: str, snapshot_date: datetime.date | str) -> str:
    date = datetime.date.fromisoformat(str(snapshot_date))
    return f"{base.rstrip('/')}/{kind}/snapshot_date={date.isoformat()}"


def write_daily(daily: DataFrame, base: str, snapshot_date: datetime.date | str) -> str:
    """Write the long daily table, zstd-compressed."""
    path = _snapshot(base, "daily", snapshot_date)
    (
        daily.select(*DAILY_COLUMNS)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(path)
    )
    return path


def write_monthly(
    sparse: DataFrame, base: str, snapshot_date: datetime.date | str, compact: bool = False
) -> str:
    """Write sparse monthly rows, one folder per dataset, snappy-compressed.

    Needs the ``dataset`` column. The whole snapshot of the date is replaced, and
    there is no output for an empty dataset. Every task writes one file per dataset
    it meets; ``compact`` spends a shuffle on fewer files, balanced by size, so that a
    large dataset still has many writers.
    """
    path = _snapshot(base, "monthly", snapshot_date)
    rows = sparse.select(*MONTHLY_COLUMNS, sink_label(F.col("dataset")).alias("dataset"))
    if compact:
        rows = rows.hint("rebalance", "dataset")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("dataset")
        .parquet(path)
    )
    return path


def write_stations(
    stations: DataFrame, base: str, network: str, snapshot_date: datetime.date | str
) -> str:
    """Write a station list, snappy-compressed."""
    path = _snapshot(base, f"stations/network={network}", snapshot_date)
    stations.select(*STATION_COLUMNS).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(path)
    return path


def snapshot_dates(spark: SparkSession, folder: str) -> list[str]:
    """Dates of the snapshots in a folder, oldest first, from the folder names alone."""
    prefix = "snapshot_date="
    names = folder_names(spark, folder)
    return [name.removeprefix(prefix) for name in names if name.startswith(prefix)]


def _snapshots(spark: SparkSession, folder: str, schema: str, snapshot: str | None) -> DataFrame:
    """All snapshots of a folder, one of them, or the ``latest``.

    A chosen snapshot is read from its own folder: no other one is listed.
    """
    reader = spark.read.schema(schema)
    if snapshot is None:
        return reader.parquet(folder)
    if snapshot == "latest":
        dates = snapshot_dates(spark, folder)
        if not dates:
            raise ValueError(f"no snapshot in {folder}")
        snapshot = dates[-1]
    path = f"{folder}/snapshot_date={datetime.date.fromisoformat(str(snapshot)).isoformat()}"
    return reader.option("basePath", folder).parquet(path)


def read_daily(spark: SparkSession, base: str, snapshot: str | None = None) -> DataFrame:
    """Daily snapshots, with their ``snapshot_date``: all, one date, or "latest"."""
    return _snapshots(spark, f"{base.rstrip('/')}/daily", DAILY_SCHEMA, snapshot)


def read_monthly(
    spark: SparkSession, base: str, dataset: str | None = None, snapshot: str | None = None
) -> DataFrame:
    """Monthly snapshots of one dataset or of all; the choice prunes folders."""
    monthly = _snapshots(spark, f"{base.rstrip('/')}/monthly", MONTHLY_SCHEMA, snapshot)
    if dataset is not None:
        monthly = monthly.filter(F.col("dataset") == dataset.lower())
    return monthly


def read_stations(
    spark: SparkSession, base: str, network: str | None = None, snapshot: str | None = None
) -> DataFrame:
    """Station snapshots of one network or of all: all dates, one date, or "latest".

    Each network has its own dates, so "latest" is the newest one of each; a network
    without the date that is asked for has no rows. Only the folders of the chosen
    networks and dates are listed and read. ValueError where none has the date.
    """
    folder = f"{base.rstrip('/')}/stations"
    if snapshot is None:
        stations = spark.read.schema(STATION_SCHEMA).parquet(folder)
        return stations if network is None else stations.filter(F.col("network") == network)
    prefix = "network="
    names = [name for name in folder_names(spark, folder) if name.startswith(prefix)]
    if network is not None:
        names = [name for name in names if name == f"{prefix}{network}"]
    wanted = None if snapshot == "latest" else datetime.date.fromisoformat(str(snapshot)).isoformat()
    paths = []
    for name in names:
        dates = snapshot_dates(spark, f"{folder}/{name}")
        chosen = dates[-1:] if wanted is None else [date for date in dates if date == wanted]
        paths += [f"{folder}/{name}/snapshot_date={date}" for date in chosen]
    if not paths:
        raise ValueError(f"no snapshot {snapshot} of stations in {folder}")
    return spark.read.schema(STATION_SCHEMA).option("basePath", folder).parquet(*paths)


def latest(snapshots: DataFrame) -> DataFrame:
    """Rows of the newest of several snapshots that are read together.

    To read one snapshot only, use ``snapshot="latest"`` of the readers. The newest
    date is a scalar subquery on the partition column: it reads no data column, and
    its result prunes the folders of the outer scan.
    """
    newest = snapshots.agg(F.max("snapshot_date")).scalar()
    return snapshots.filter(F.col("snapshot_date") == newest)
