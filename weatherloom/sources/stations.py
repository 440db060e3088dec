"""Station lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import blank_to_null, cut, lenient_real, line_bytes, line_length, trimmed
from ..functions.layouts import STATION_LAYOUTS, StationLayout
from .text import read_lines

STATION_COLUMNS = (
    "country_code",
    "network_code",
    "id_placeholder",
    "coop_id",
    "latitude",
    "longitude",
    "elevation",
    "state",
    "name",
)


def _too_short(raw: Column, layout: StationLayout) -> Column:
    return line_length(raw) < layout.min_length


def parse_stations(lines: DataFrame, layout: StationLayout | str) -> DataFrame:
    """Station lines as rows. Columns other than ``line`` pass through, among
    them ``position``, which orders duplicate stations."""
    if isinstance(layout, str):
        layout = STATION_LAYOUTS[layout]
    raw = F.col("raw")
    kept = [name for name in lines.columns if name != "line"]
    return (
        lines.withColumn("raw", line_bytes(F.col("line")))
        .filter(~_too_short(raw, layout))
        .select(
            *kept,
            cut(raw, layout.country_code).alias("country_code"),
            cut(raw, layout.network_code).alias("network_code"),
            cut(raw, layout.id_placeholder).alias("id_placeholder"),
            cut(raw, layout.coop_id).alias("coop_id"),
            lenient_real(cut(raw, layout.latitude)).alias("latitude"),
            lenient_real(cut(raw, layout.longitude)).alias("longitude"),
            lenient_real(cut(raw, layout.elevation)).alias("elevation"),
            blank_to_null(cut(raw, layout.state)).alias("state"),
            trimmed(cut(raw, layout.station_name)).alias("name"),
        )
    )


def rejected_stations(lines: DataFrame, layout: StationLayout | str) -> DataFrame:
    """Lines too short to be a station."""
    if isinstance(layout, str):
        layout = STATION_LAYOUTS[layout]
    return lines.filter(_too_short(line_bytes(F.col("line")), layout))


def scan_stations(
    spark: SparkSession, paths: str | Sequence[str], layout: StationLayout | str
) -> DataFrame:
    """Stations of one or more station lists, with their ``position``."""
    return parse_stations(station_lines(spark, paths), layout)


def station_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The lines of station lists, in order of the lists."""
    return read_lines(spark, paths, with_position=True)
