"""The given tables, written as station records.

Each function derives fixed-width lines from a whole table, so that the queries
run the real scans and reshaping operators on input that grows with the tables.

Daily lines come from ``lineitem``: the supplier is the station, the ship date
the day, return flag and line status choose the element, and the largest
quantity of a day is its value. Monthly lines come from ``orders``: sixteen
customers share a station, order status is the dataset, the order key chooses
the element, and the largest total price of a month is its value. Value and
flags of a slot are packed into one integer so that a maximum keeps them
together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

DAILY_SOURCES = "ZRD06CX"
# compressed text cannot be split, so no file has more lines
LINES_PER_FILE = 200_000
MONTHLY_FLAGS = "abcde"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hex_id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.hex(key), 8, "0"))


def right(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, " ")


def char_of(text: str, position: Column) -> Column:
    """One-based character of a constant text."""
    return F.substring(F.lit(text), position, F.lit(1))


def _slots(count: int, day: Column, packed: Column) -> list[Column]:
    """One maximum per slot: a fixed-size state that combines before the
    shuffle, where a collected list would grow with the group."""
    return [F.max(F.when(day == i, packed)).alias(f"s{i}") for i in range(1, count + 1)]


def _joined(count: int, slot: Callable[[Column], Column]) -> Column:
    """The texts of all slots of a line."""
    packed = F.array(*[f"s{i}" for i in range(1, count + 1)])
    return F.array_join(F.transform(packed, slot), "")


def encode_daily(spark: SparkSession, folder: str) -> DataFrame:
    """``file_name`` and ``line`` of daily records, one file per station.

    A line's slots are mostly empty, so days travel as narrow rows: the largest value of
    each day first, with a partial step, then the at most 31 days of a line, sorted once
    and joined in a running list. No task holds a wide row for each line it has begun.
    """
    date = F.col("l_shipdate").cast("date")
    element = (
        F.when(F.col("l_returnflag") == "A", "TMAX")
        .when(F.col("l_returnflag") == "N", "TMIN")
        .when(F.col("l_linestatus") == "O", "PRCP")
        .otherwise("SNOW")
    )
    tenths = (F.col("l_quantity") * 10).cast("int") - 200
    cells = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("station"),
        date.alias("date"),
        element.alias("element"),
        ((tenths + 1000) * 8 + F.col("l_linenumber")).alias("packed"),
    )
    days = cells.groupBy("station", "element", "date").agg(F.max("packed").alias("packed"))
    days = days.withColumn("month", F.date_format("date", "yyyyMM"))

    packed = F.col("packed")
    line = packed % 8
    text = F.concat(
        right(F.shiftright(packed, 3) - 1000, 5),
        F.when(line == 1, "T").otherwise(" "),
        F.when(line >= 6, "X").otherwise(" "),
        char_of(DAILY_SOURCES, line),
    )
    cell = F.when(text.isNotNull(), F.struct(F.dayofmonth("date").alias("day"), text.alias("text")))
    keys = ["station", "month", "element"]
    rising = Window.partitionBy(*keys).orderBy("date")
    lines = (
        days.repartition(*keys)
        .select(*keys, "date", cell.alias("cell"))
        .withColumn("cells", F.collect_list("cell").over(rising.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("last", F.lead(F.lit(False), 1, True).over(rising))
        .filter("last")
    )

    def missing(count: Column) -> Column:
        return F.repeat(F.lit("-9999   "), count)

    def day_before(slot: Column) -> Column:
        return F.coalesce(F.get("cells", slot)["day"], F.lit(0))

    slots = F.transform("cells", lambda c, i: F.concat(missing(c["day"] - day_before(i - 1) - 1), c["text"]))
    body = F.concat(F.array_join(slots, ""), missing(31 - day_before(F.size("cells") - 1)))
    station = hex_id("USC", F.col("station"))
    return lines.select(
        F.concat(station, F.lit(".dly")).alias("file_name"),
        F.concat(station, "month", "element", body).alias("line"),
    )


def monthly_file_name(station: Column, status: Column, order: Column) -> Column:
    dataset = F.when(status == "F", "FLs.52j").when(status == "O", "raw").otherwise("tob")
    element = F.when(order % 3 == 0, "tmax").when(order % 3 == 1, "tmin").otherwise("tavg")
    return F.concat_ws(".", station, dataset, element)


def encode_monthly(spark: SparkSession, folder: str, step: int = 100) -> DataFrame:
    """``file_name``, ``position`` and ``line`` of monthly records, one file per
    station, dataset and element. A larger ``step`` gives coarser values."""
    station = hex_id("USH", F.floor(F.col("o_custkey") / 16).cast("long"))
    hundredths = (F.floor(F.col("o_totalprice") / step) * F.lit(step // 100)).cast("int") - 1500
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    cells = table(spark, folder, "orders").select(
        monthly_file_name(station, F.col("o_orderstatus"), F.col("o_orderkey")).alias("file_name"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        ((hundredths + 20000) * 8 + priority).alias("packed"),
    )
    lines = cells.groupBy("file_name", "year").agg(*_slots(12, F.col("month"), F.col("packed")))

    def slot(packed: Column) -> Column:
        flag = packed % 8
        text = F.concat(
            right(F.shiftright(packed, 3) - 20000, 6),
            char_of(MONTHLY_FLAGS, flag),
            F.when(flag == 5, "D").otherwise(" "),
            flag.cast("string"),
        )
        return F.coalesce(text, F.lit(" -9999   "))

    year = F.lpad(F.col("year").cast("string"), 4, "0")
    header = F.concat(F.substring("file_name", 1, 11), F.lit(" "), year)
    return lines.select(
        "file_name", F.col("year").alias("position"), F.concat(header, _joined(12, slot)).alias("line")
    )


def _station_line(
    id: Column, lat: Column, lon: Column, elevation: Column, state: Column, name: Column
) -> Column:
    return F.concat(
        id,
        F.lit(" "),
        right(lat, 8),
        F.lit(" "),
        right(lon, 9),
        F.lit(" "),
        right(elevation, 6),
        F.lit(" "),
        F.rpad(state, 2, " "),
        F.lit(" "),
        F.rpad(name, 30, " "),
        F.lit(" "),
    )


def _decimal(number: Column, digits: int) -> Column:
    """Integer in units of the last digit to text, without floating point."""
    exact = number.cast("decimal(18,0)") / F.lit(10**digits)
    return exact.cast(f"decimal(18,{digits})").cast("string")


def encode_daily_stations(spark: SparkSession, folder: str) -> DataFrame:
    """``position`` and ``line`` of the daily network's stations.

    Every seventh supplier lacks a latitude, some are listed again later with
    other coordinates, and some again without a longitude.
    """
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when(nation % 5 == 0, 1),
            F.when(nation % 3 == 0, 2),
        )
    )
    suppliers = table(spark, folder, "supplier").select(
        "s_suppkey", "s_nationkey", "s_name", F.explode(copies).alias("copy")
    )
    copy = F.col("copy")
    lat = _decimal(F.lit(250000) + (key * 7919 + copy * 11) % 240000, 4)
    lon = _decimal(F.lit(-1200000) + (key * 104729 + copy * 13) % 400000, 4)
    elevation = _decimal((key * 31) % 50000, 1)
    line = _station_line(
        hex_id("USC", key),
        F.when((key % 7 == 0) & (copy == 0), "-999.9").otherwise(lat),
        F.when(copy == 2, "-999.9").otherwise(lon),
        F.when(key % 4 == 0, "-999.9").otherwise(elevation),
        F.when(nation % 6 == 0, "").otherwise(F.concat(F.lit("S"), F.chr(nation + 65))),
        F.upper("s_name"),
    )
    return suppliers.select((key * 3 + copy).alias("position"), line.alias("line"))


def encode_monthly_stations(spark: SparkSession, folder: str) -> DataFrame:
    """``position`` and ``line`` of the monthly network's stations: one line per
    customer, so a station is listed up to sixteen times."""
    key = F.col("c_custkey")
    line = _station_line(
        hex_id("USH", F.floor(key / 16).cast("long")),
        _decimal(F.lit(250000) + (key * 7919) % 240000, 4),
        F.when(key % 5 == 0, "-999.9").otherwise(
            _decimal(F.lit(-1200000) + (key * 104729) % 400000, 4)
        ),
        _decimal((key * 31) % 9999, 1),
        F.concat(F.lit("C"), F.chr(F.col("c_nationkey") + 65)),
        F.upper("c_name"),
    )
    return table(spark, folder, "customer").select(key.alias("position"), line.alias("line"))


_stored: dict[tuple, str] = {}


def stored(
    spark: SparkSession,
    folder: str,
    name: str,
    build: Callable[[], DataFrame],
    as_text: bool = False,
) -> str:
    """Write what ``build`` returns to the shared folder, once per application;
    returns the path.

    Like a real archive, the lines are encoded once and scanned by many
    queries. It also keeps the encoder's long expressions out of their plans.
    Text is compressed: nearly all of it is blanks and missing values.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        df = build()
        if as_text:
            lines = df.select("line").write.option("maxRecordsPerFile", LINES_PER_FILE)
            lines.text(path, compression="gzip")
        else:
            df.write.parquet(path)
        _stored[key] = path
    return _stored[key]


def stored_table(
    spark: SparkSession, folder: str, name: str, schema: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A stored table of known schema."""
    return spark.read.schema(schema).parquet(stored(spark, folder, name, build))


def daily_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded daily lines with their ``file_name``."""
    build = partial(encode_daily, spark, folder)
    return stored_table(spark, folder, "daily-lines", "file_name string, line string", build)


def daily_text(spark: SparkSession, folder: str) -> str:
    """Folder of text files with the encoded daily lines."""
    return stored(spark, folder, "daily-text", lambda: daily_lines(spark, folder), as_text=True)


def monthly_lines(spark: SparkSession, folder: str, step: int = 100) -> DataFrame:
    """Encoded monthly lines with their ``file_name`` and ``position``."""
    build = partial(encode_monthly, spark, folder, step)
    schema = "file_name string, position int, line string"
    return stored_table(spark, folder, f"monthly-lines-{step}", schema, build)


def daily_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded station list of the daily network with its ``position``."""
    build = partial(encode_daily_stations, spark, folder)
    return stored_table(spark, folder, "daily-stations", "position long, line string", build)


def monthly_stations(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded station list of the monthly network with its ``position``."""
    build = partial(encode_monthly_stations, spark, folder)
    return stored_table(spark, folder, "monthly-stations", "position long, line string", build)


def two_station_lists(spark: SparkSession, folder: str) -> list[str]:
    """The daily network's list as two: odd positions, then even ones."""

    def part(even: int) -> DataFrame:
        stations = daily_stations(spark, folder)
        return stations.filter(F.col("position") % 2 == 1 - even).orderBy("position")

    return [
        stored(spark, folder, f"station-list-{even}", lambda even=even: part(even), as_text=True)
        for even in (0, 1)
    ]


def station_text(spark: SparkSession, folder: str, network: str) -> str:
    """Folder of text files with a station list."""
    stations = {"daily": daily_stations, "monthly": monthly_stations}[network]
    return stored(
        spark, folder, f"{network}-station-text", lambda: stations(spark, folder), as_text=True
    )


def monthly_folder(spark: SparkSession, folder: str, averages_named: bool = True) -> str:
    """Folder of text files with the names of a real archive, for scans that take
    dataset and element from the file name. Files of averages may go without
    these parts of their names."""
    name = "monthly-folder" if averages_named else "monthly-folder-unnamed"
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        lines = monthly_lines(spark, folder)
        if not averages_named:
            bare = F.regexp_replace("file_name", r"\..*tavg$", "")
            lines = lines.withColumn("file_name", bare)
        named_files(lines, path).write.format("noop").mode("overwrite").save()
        _stored[key] = path
    return _stored[key]


def named_files(lines: DataFrame, folder: str) -> DataFrame:
    """Write lines to text files of their names, below one folder for each task.

    The station's last four letters are left out of the names, which makes fewer
    files of more stations. A task that is repeated writes the same folder again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import pyarrow
        from pyarrow import fs
        from pyspark import TaskContext

        uri = re.sub("^s3a://", "s3://", re.sub("^file:/+", "/", folder))
        store, root = fs.FileSystem.from_uri(uri)
        root = f"{root}/{TaskContext.get().partitionId():05d}"
        store.create_dir(root, recursive=True)
        name, stream, count = None, None, 0
        for batch in batches:
            for file_name, line in zip(*(column.to_pylist() for column in batch.columns)):
                if file_name != name:
                    if stream:
                        stream.close()
                    name, stream = file_name, store.open_output_stream(f"{root}/{file_name}")
                stream.write(line.encode() + b"\n")
                count += 1
        if stream:
            stream.close()
        yield pyarrow.RecordBatch.from_arrays([pyarrow.array([count])], names=["n_lines"])

    part = F.concat(F.substring("file_name", 1, 7), F.lit("0000"), F.substring("file_name", 12, 99))
    files = lines.select(part.alias("file_name"), "line")
    ordered = files.repartitionByRange("file_name", "line").sortWithinPartitions("file_name", "line")
    return ordered.mapInArrow(write, "n_lines long")


def monthly_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives holding the monthly lines, in column ``archive``."""
    return stored_table(
        spark,
        folder,
        "monthly-archives",
        "archive string",
        lambda: packed_archives(monthly_lines(spark, folder), "archives"),
    )


def packed_archives(lines: DataFrame, name: str) -> DataFrame:
    """Write lines as tar.gz archives to the shared folder, one per task and
    batch by batch, and return their paths in column ``archive``.

    Every attempt writes under a name of its own. Store the returned list before
    use: it then names one finished archive per task.
    """
    folder = scratch_path(lines.sparkSession, name)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import re
        import tarfile
        import uuid

        import pyarrow
        from pyarrow import fs

        uri = re.sub("^s3a://", "s3://", re.sub("^file:/+", "/", folder))
        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        path = f"{root}/{uuid.uuid4().hex}.tar.gz"
        with (
            store.open_output_stream(path, compression=None) as stream,
            tarfile.open(fileobj=stream, mode="w|gz", compresslevel=1) as tar,
        ):
            for batch in batches:
                members: dict[str, list[str]] = {}
                for file_name, line in zip(*(column.to_pylist() for column in batch.columns)):
                    members.setdefault(file_name, []).append(line)
                for file_name, content in members.items():
                    data = ("\n".join(content) + "\n").encode()
                    info = tarfile.TarInfo(f"release/{file_name}")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
        full = f"{folder}/{path.rsplit('/', 1)[-1]}"
        yield pyarrow.RecordBatch.from_arrays([pyarrow.array([full])], names=["archive"])

    # neighbouring lines of a file become one member; a range of (name, position)
    # may cut a large file, so no task depends on the size of a file
    ordered = lines.repartitionByRange("file_name", "position").sortWithinPartitions(
        "file_name", "position"
    )
    return ordered.select("file_name", "line").mapInArrow(pack, "archive string")
