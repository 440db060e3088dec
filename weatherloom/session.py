"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "weatherloom", **settings: str) -> SparkSession:
    """A session with the settings the library is planned for.

    Everything given in ``settings`` (dots written as ``__``) wins. The master
    comes from spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # thousands of small station files: pack them into few read tasks
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.files.openCostInBytes": "1m",
        # monthly output: a few datasets per task are written side by side
        # instead of being sorted first
        "spark.sql.maxConcurrentOutputFileWriters": "8",
    }
    defaults.update({key.replace("__", "."): value for key, value in settings.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        if folder.startswith("file:") and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is a local folder; executors cannot share it")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weatherloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage and keeps column pruning and filter pushdown for the
    readers of the result.
    """
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``materialise``, with the path, for a caller that removes it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table that is not read any more."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that the session's settings give it."""
    files, hadoop = _file_system(spark, path)
    return files.makeQualified(hadoop).toString()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names one level below a folder; none where it does not exist."""
    files, hadoop = _file_system(spark, path)
    if not files.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(hadoop))
