"""Compressed tar archives."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.layouts import ARCHIVE_DATASETS, ARCHIVE_ELEMENTS
from ..session import qualified

BLOCK_SCHEMA = (
    "archive string, file_name string, block long, first_line long, content binary"
)
BLOCK_BYTES = 4 << 20


def arrow_uri(path: Column) -> Column:
    """A qualified path as Spark names it, as Arrow's file systems name it."""
    local = F.regexp_replace(path, r"^file:/+", "file:///")
    return F.regexp_replace(local, r"^s3a://", "s3://")


def qualified_path(spark: SparkSession, path: Column) -> Column:
    """Paths with scheme and authority, by the session's settings.

    Tasks do not know the default file system or the working folder; both are
    asked for once.
    """
    root = qualified(spark, "/").rstrip("/")
    here = qualified(spark, ".").rstrip("/")
    return (
        F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), path)
        .when(path.startswith("/"), F.concat(F.lit(root), path))
        .otherwise(F.concat(F.lit(f"{here}/"), path))
    )


def archive_manifest(
    spark: SparkSession,
    network: str,
    root: str = "",
    elements: Sequence[str] = ARCHIVE_ELEMENTS,
    datasets: Sequence[str] = ARCHIVE_DATASETS,
) -> DataFrame:
    """Every element with every dataset: the names of the monthly archives."""
    element = F.explode(F.array(*map(F.lit, elements))).alias("archive_element")
    dataset = F.explode(F.array(*map(F.lit, datasets))).alias("archive_dataset")
    prefix = f"{root.rstrip('/')}/" if root else ""
    return (
        spark.range(1)
        .select(element)
        .select("archive_element", dataset)
        .withColumn(
            "archive",
            F.format_string(
                "%s%s.%s.latest.%s.tar.gz",
                F.lit(prefix),
                F.lit(network),
                F.col("archive_element"),
                F.col("archive_dataset"),
            ),
        )
    )


def unpack_archives(
    archives: DataFrame,
    spread: int | None = None,
    block_bytes: int = BLOCK_BYTES,
    max_tasks: int = 20_000,
) -> DataFrame:
    """The lines of the archives named in column ``archive``, with ``file_name``
    and ``position`` (block, row), where the row is the line's number.

    A gzip stream cannot be split: every archive gets a task of its own, up to
    ``max_tasks`` tasks, beyond which some tasks read several. That task only
    decompresses: it passes on blocks of whole lines, about ``block_bytes`` each,
    which are cut into lines by the JVM. ``spread`` deals the blocks out to that
    many tasks before they are cut.

    All members of the gzip stream and all tar files in it are read. A damaged
    archive, or one that ends before the end mark of its last tar file, is an error
    that names it. Paths are opened through Arrow's file systems, so they may lie on
    any shared store, and a lost task just reads its archive again.
    """
    spark = archives.sparkSession
    archives = archives.select("archive").distinct()
    paths = archives.withColumn("uri", arrow_uri(qualified_path(spark, F.col("archive"))))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow

        schema = pyarrow.schema(
            [
                ("archive", pyarrow.string()), ("file_name", pyarrow.string()),
                ("block", pyarrow.int64()), ("first_line", pyarrow.int64()), ("content", pyarrow.binary()),
            ]
        )
        for batch in batches:
            for archive, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for number, block in enumerate(archive_blocks(archive, uri, block_bytes)):
                    name, first, content = block
                    row = dict(archive=archive, file_name=name, block=number, first_line=first, content=content)
                    yield pyarrow.RecordBatch.from_pylist([row], schema)

    apart = paths.repartitionByRange(min(max(paths.count(), 1), max_tasks), "archive")
    blocks = apart.mapInArrow(unpack, BLOCK_SCHEMA)
    if spread:
        blocks = blocks.repartition(spread, "archive", "block")
    # one byte, one letter: lines in any encoding come out byte for byte
    letters = F.decode("content", "ISO-8859-1")
    lines = blocks.select(
        "archive", "file_name", "block", "first_line",
        F.posexplode(F.split(letters, "\n")).alias("row", "letters"),
    )
    return lines.select(
        "archive",
        "file_name",
        F.struct("block", (F.col("first_line") + F.col("row")).alias("row")).alias("position"),
        F.encode("letters", "ISO-8859-1").cast("string").alias("line"),
    )


def archive_blocks(archive: str, uri: str, block_bytes: int) -> Iterator[tuple[str, int, bytes]]:
    """(member, number of the first line, bytes of whole lines) of one archive.

    A block ends before a line feed or at the end of its member, so an empty
    member has none and a line longer than ``block_bytes`` is one block.
    """
    import gzip
    import tarfile
    import zlib

    from pyarrow import fs

    ended = False

    class Header(tarfile.TarInfo):
        """Tells the end mark from the end of the data, and lets no bad header pass."""

        @classmethod
        def frombuf(cls, buffer, encoding, errors):
            nonlocal ended
            if not buffer:
                return super().frombuf(buffer, encoding, errors)
            ended = len(buffer) == tarfile.BLOCKSIZE and not any(buffer)
            try:
                return super().frombuf(buffer, encoding, errors)
            except (tarfile.InvalidHeaderError, tarfile.TruncatedHeaderError) as error:
                raise ValueError(str(error)) from error

    try:
        store, path = fs.FileSystem.from_uri(uri)
        with (
            store.open_input_stream(path, compression=None) as stream,
            gzip.GzipFile(fileobj=stream) as plain,
            tarfile.open(fileobj=plain, mode="r|", tarinfo=Header, ignore_zeros=True) as tar,
        ):
            for member in tar:
                if member.isfile():
                    name = member.name.rsplit("/", 1)[-1]
                    for first, content in _line_blocks(tar.extractfile(member), block_bytes):
                        yield name, first, content
        if not ended:
            raise ValueError("it ends before the end mark")
    except (tarfile.TarError, zlib.error, EOFError, OSError, ValueError) as error:
        raise ValueError(f"archive {archive} cannot be read to its end: {error}") from error


def _line_blocks(member, block_bytes: int) -> Iterator[tuple[int, bytes]]:
    first, rest = 1, b""
    while chunk := member.read(block_bytes):
        whole, feed, tail = chunk.rpartition(b"\n")
        if feed:
            content = rest + whole
            yield first, content
            first, rest = first + content.count(b"\n") + 1, tail
        else:
            rest += chunk
    if rest:
        yield first, rest
