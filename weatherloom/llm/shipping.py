"""Python code on the executors."""

from __future__ import annotations

import os
import pathlib
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

ARCHIVE = "weatherloom_package.zip"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, as ``--py-files`` would."""
    context = spark.sparkContext
    if any(os.path.basename(name) == ARCHIVE for name in context._python_includes):
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="package-")), ARCHIVE)
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(path)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
