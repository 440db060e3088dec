"""Daily files that arrive in a landing folder.

The batch operators are used unchanged: scan, filter, coordinate join and
reshape are stateless, so the stream needs no watermark and appends only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.layouts import CORE_ELEMENTS, DAILY
from ..operators.joins import inject_coords
from ..operators.reshape import to_daily_long
from ..sources.readings import parse_daily, rejected_lines


def landing_lines(
    spark: SparkSession, folder: str, max_files_per_trigger: int = 10_000
) -> DataFrame:
    """Lines of the files that appear in ``folder``."""
    return (
        spark.readStream.option("lineSep", "\n")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .text(folder)
        .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line"))
    )


def stream_daily(
    lines: DataFrame, lookup: DataFrame, elements: Sequence[str] | None = CORE_ELEMENTS
) -> DataFrame:
    """Long daily rows of a stream of lines, with coordinates from a static
    station lookup."""
    return to_daily_long(inject_coords(parse_daily(lines.select("line"), elements), lookup))


def append_with_rejects(
    lines: DataFrame,
    lookup: DataFrame,
    path: str,
    rejects_path: str,
    checkpoint: str,
    elements: Sequence[str] | None = CORE_ELEMENTS,
) -> StreamingQuery:
    """Append a stream of lines to the daily table, and the lines that are no
    records, with file name and reason, to a table of their own.

    Each batch replaces a folder of its own in both tables, named by its number.
    A batch that is repeated after a failure therefore writes the same rows to
    the same place. Both tables read as one, with a ``batch`` column.
    """

    def write(batch: DataFrame, number: int) -> None:
        for rows, target in (
            (stream_daily(batch, lookup, elements), path),
            (rejected_lines(batch, DAILY), rejects_path),
        ):
            folder = f"{target.rstrip('/')}/batch={number}"
            rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_daily(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a daily stream to Parquet, processing what is there and stopping.

    The checkpoint folder and the sink's log make a restarted query write each
    input file once.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
