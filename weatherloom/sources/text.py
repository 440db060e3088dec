"""Line sources: directories of text files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    recursive: bool = False,
    with_position: bool = False,
    with_file_name: bool = True,
) -> DataFrame:
    """One row per line: ``file_name``, ``line`` and, on request, ``position``.

    Leave the file name out where it is not used: it is attached to every row
    before unused columns are pruned.

    Many paths are one scan. Input splits are the unit of parallelism, so a
    large file is read by many tasks and small files share one. ``position``
    orders all lines: the place of their path among ``paths``, the file's path,
    the start of the split in the file, then a counter that grows within the
    split. With positions, every path is a scan of its own. Spark leaves out
    files whose names begin with an underscore or a dot.
    """
    if with_position and not isinstance(paths, str):
        parts = [
            read_lines(spark, path, pattern, recursive, True, with_file_name).withColumn(
                "position", F.col("position").withField("list", F.lit(number))
            )
            for number, path in enumerate(paths)
        ]
        return reduce(DataFrame.unionByName, parts)
    reader = spark.read.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    columns = [F.col("value").alias("line")]
    if with_file_name:
        columns.insert(0, F.col("_metadata.file_name").alias("file_name"))
    if with_position:
        columns.append(
            F.struct(
                F.lit(0).alias("list"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("position")
        )
    return reader.text(list(paths) if not isinstance(paths, str) else paths).select(*columns)


def list_files(
    spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True
) -> DataFrame:
    """One row per file (``file_name``, ``path``); no content is read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")
