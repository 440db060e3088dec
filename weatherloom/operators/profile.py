"""Profiling of monthly text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import cut, line_bytes, line_chunks, line_length, unsigned_int
from ..functions.layouts import MONTHLY, SlotLayout
from ..session import materialise
from ..sources.archives import unpack_archives
from ..sources.text import list_files, read_lines

# lines shorter than the header are left out of the statistics
HEADER_LENGTH = MONTHLY.first_slot


def sample_lines(lines: DataFrame, count: int) -> DataFrame:
    """The first lines, by file name and position.

    Only ``count`` rows per task are kept and merged, not a full sort. To look into a
    folder of files, ``first_lines`` reads only the first of them.
    """
    return lines.orderBy("file_name", "position").limit(count)


def first_lines(
    spark: SparkSession, path: str, count: int, pattern: str | None = None, recursive: bool = True
) -> DataFrame:
    """The first lines of a folder, by file name, path and position.

    Files are listed first, and only as many of them are read as hold ``count`` lines:
    one as a rule. A file is not read for its name to be known.
    """
    listed = list_files(spark, path, pattern, recursive).orderBy("file_name", "path")
    take = 1
    while True:
        paths = [row.path for row in listed.limit(take).collect()]
        if not paths:
            return read_lines(spark, path, pattern, recursive, with_position=True).limit(0)
        lines = read_lines(spark, paths, with_position=True)
        if len(paths) < take or lines.limit(count).count() >= count:
            return lines.orderBy("position").limit(count)
        take *= 4


def lines_of_first_file(
    spark: SparkSession, path: str, suffix: str = "tmax", recursive: bool = True
) -> DataFrame | None:
    """Lines of the first file of a folder, by name, with the suffix, or None.

    The listing finds the file; no other one is read.
    """
    found = first_matching_file(spark, path, suffix, recursive)
    return None if found is None else read_lines(spark, found, with_position=True)


def first_matching_file(
    spark: SparkSession, path: str, suffix: str = "tmax", recursive: bool = True
) -> str | None:
    """Path of the first file, by name, with the suffix. Looks at the file
    listing only; a single name comes back to the driver."""
    files = list_files(spark, path, f"*.{suffix}", recursive)
    return files.agg(F.min_by("path", F.struct("file_name", "path"))).first()[0]


def first_file_lines(lines: DataFrame, suffix: str = "tmax") -> DataFrame:
    """Lines of the first file, by name, with the suffix.

    For lines whose files cannot be listed, like members of archives: finding the name
    is a pass over the names of all lines. Of a folder, use ``lines_of_first_file``.
    """
    matching = lines.filter(F.col("file_name").endswith(f".{suffix}"))
    return lines.filter(F.col("file_name") == matching.agg(F.min("file_name")).scalar())


def profile_monthly(lines: DataFrame, first_lines: int | None = None) -> DataFrame:
    """Distinct stations and years and the year range.

    Whole input by default; ``first_lines`` restricts the statistics to the
    first lines in file order. Lines with an unreadable year count for the
    stations only.
    """
    if first_lines is not None:
        lines = sample_lines(lines, first_lines)
    raw = line_bytes(F.col("line"))
    parsed = lines.filter(line_length(raw) >= HEADER_LENGTH).select(
        cut(raw, MONTHLY.id).alias("id"), unsigned_int(cut(raw, MONTHLY.year), 4).alias("year")
    )
    # one row per station and year first; both counts read these few rows
    pairs = parsed.groupBy("id", "year").agg(F.count(F.lit(1)).alias("n_lines"))
    stations = pairs.select("id").distinct().agg(F.count("id").alias("n_stations"))
    years = pairs.select("year").distinct().agg(
        F.count("year").alias("n_years"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )
    return years.select(
        stations.scalar().alias("n_stations"), "n_years", "first_year", "last_year"
    )


def file_statistics(lines: DataFrame) -> DataFrame:
    """Lines per file and the length of the first one.

    Counted per input split first, then per file: both steps are hash aggregates
    over plain numbers, and a large file sends one row per split.
    """
    block, row = F.lit(0), F.col("position")
    if dict(lines.dtypes)["position"].startswith("struct"):
        block, row = F.col("position.block"), F.col("position.row")
    per_split = lines.groupBy("file_name", block.alias("block")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min_by(line_length(line_bytes(F.col("line"))), row).alias("first_length"),
    )
    return per_split.groupBy("file_name").agg(
        F.sum("n_lines").alias("n_lines"),
        F.min_by("first_length", "block").alias("first_line_length"),
    )


def explain_layout(lines: DataFrame, layout: SlotLayout = MONTHLY) -> DataFrame:
    """The slots of each line as they stand in the text, flags included."""
    raw = line_bytes(F.col("line"))
    chunks = line_chunks(raw, layout.first_slot, layout.slot_width, layout.slots)
    kept = [name for name in lines.columns if name != "line"]
    return (
        lines.filter(line_length(raw) >= HEADER_LENGTH)
        .select(
            *kept,
            cut(raw, layout.id).alias("id"),
            cut(raw, layout.year).alias("year"),
            F.posexplode(chunks).alias("slot", "chunk"),
        )
        .withColumn("slot", F.col("slot") + 1)
    )


def examine_sample(
    spark: SparkSession, path: str, suffix: str = "tmax", count: int = 5
) -> dict[str, DataFrame]:
    """Profile of the first matching file of a folder: its statistics, sample
    lines, the layout of its first line, and its stations and years. Only this
    file is read."""
    lines = lines_of_first_file(spark, path, suffix)
    return {} if lines is None else examine_lines(lines, count)


def examine_archives(
    archives: DataFrame, suffix: str = "tmax", count: int = 5
) -> dict[str, DataFrame]:
    """The same of the first matching member of archives, by member name.

    The lines are unpacked once and stored, since a member is only found by
    reading its archive.
    """
    lines = materialise(unpack_archives(archives), "archive-lines")
    return examine_lines(first_file_lines(lines, suffix), count)


def examine_lines(lines: DataFrame, count: int = 5) -> dict[str, DataFrame]:
    """Statistics, sample, layout of the first line, and profile of a file's lines."""
    return {
        "statistics": file_statistics(lines),
        "sample": sample_lines(lines, count),
        "layout": explain_layout(sample_lines(lines, 1)),
        "profile": profile_monthly(lines, first_lines=100),
    }
