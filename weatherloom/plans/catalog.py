"""The operators as queries on the given tables, with their expected results.

Every query works on whole tables. ``BUILDERS`` maps a name to a function of
(session, table folder), ``QUERIES`` to the same with the result shown in
comparable types, and ``ORACLES`` to SQL over the same tables.
Results are shown with ISO dates, whole numbers as BIGINT and rounded DOUBLEs,
so that two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import weatherloom as wl

from ..functions import columns as C
from ..functions.layouts import CORE_ELEMENTS, DAILY, MONTHLY
from ..operators.integrity import DAILY_REQUIRED, required, temperature_rules
from ..operators.reshape import MEASURES
from ..session import scratch_path
from . import encode
from .encode import table
from .oracles import (
    DAILY_CELLS,
    DAILY_SLOT,
    DAILY_STATIONS,
    MEASURE_NAMES,
    MONTHLY_CELLS,
    MONTHLY_STATIONS,
    MONTHLY_TEXT,
    SPARSE_COLUMNS,
    WIDE_COLUMNS,
    measure,
    monthly_cells,
    number,
    text,
    whole,
)

Query = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Query] = {}
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SNAPSHOT = "2025-06-27"
LOOKUP_SCHEMA = "id string, lat float, lon float"


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, folder: shown(build(spark, folder))
        ORACLES[name] = oracle
        return build

    return register


def shown(df: DataFrame, digits: int = 4) -> DataFrame:
    """Column types that compare across engines."""
    columns = []
    for name, dtype in df.dtypes:
        column = F.col(name)
        if dtype in ("float", "double") or dtype.startswith("decimal"):
            # adding zero turns a negative zero into a plain one
            column = F.round(column.cast("double"), 6 if name.startswith("mean") else digits) + 0.0
        elif dtype in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        elif dtype == "date":
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


# --- shared inputs ----------------------------------------------------------


def daily_readings(spark: SparkSession, folder: str) -> DataFrame:
    return wl.scan_daily(spark, encode.daily_text(spark, folder)).readings


def monthly_readings(spark: SparkSession, folder: str, step: int = 100) -> DataFrame:
    lines = encode.monthly_lines(spark, folder, step).drop("position")
    return wl.parse_monthly(lines).drop("file_name")


def scanned_monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly readings of text files that are named as in an archive."""
    return wl.scan_monthly(spark, encode.monthly_folder(spark, folder), recursive=True).readings


def build_daily_lookup(spark: SparkSession, folder: str) -> DataFrame:
    lines = encode.daily_stations(spark, folder)
    return wl.station_lookup(wl.parse_stations(lines, "daily_network"))


def build_monthly_lookup(spark: SparkSession, folder: str) -> DataFrame:
    lines = encode.monthly_stations(spark, folder)
    return wl.station_lookup(wl.parse_stations(lines, "monthly_network"))


def daily_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup as a run stores it, once for all joins."""
    build = partial(build_daily_lookup, spark, folder)
    return encode.stored_table(spark, folder, "daily-lookup", LOOKUP_SCHEMA, build)


def monthly_lookup(spark: SparkSession, folder: str) -> DataFrame:
    build = partial(build_monthly_lookup, spark, folder)
    return encode.stored_table(spark, folder, "monthly-lookup", LOOKUP_SCHEMA, build)


def daily_table(spark: SparkSession, folder: str) -> DataFrame:
    readings = daily_readings(spark, folder)
    return wl.to_daily_long(wl.inject_coords(readings, daily_lookup(spark, folder)))


def monthly_table(spark: SparkSession, folder: str, keep_dataset: bool = False) -> DataFrame:
    readings = scanned_monthly(spark, folder)
    located = wl.inject_coords(readings, monthly_lookup(spark, folder))
    return wl.to_monthly_sparse(located, keep_dataset)


LOCATED_DAILY = f"WITH {DAILY_CELLS}, {DAILY_STATIONS}"
LOCATED_MONTHLY = f"WITH {MONTHLY_CELLS}, {MONTHLY_STATIONS}"
DAILY_ROWS = f"""
SELECT id, {text('date')} AS date, element, 'UNKNOWN' AS dataset, {number('value')} AS value,
       {number('lat')} AS lat, {number('lon')} AS lon
FROM daily LEFT JOIN daily_lookup USING (id)"""
SPARSE_ROWS = f"""
SELECT id, {text('date')} AS date, {SPARSE_COLUMNS}, {number('lat')} AS lat, {number('lon')} AS lon
FROM monthly LEFT JOIN monthly_lookup USING (id)"""


# --- A: sources -------------------------------------------------------------


def reading_summary(readings: DataFrame, *keys: str) -> DataFrame:
    """A reading's values as numbers: how many, first, last, and their sum."""
    values = F.col("values")
    present = F.filter(values, lambda v: v.isNotNull())
    return readings.select(
        *keys,
        F.size(present).alias("n_values"),
        F.get(values, 0).alias("first_value"),
        F.element_at(values, -1).alias("last_value"),
        F.aggregate(present, F.lit(0.0), lambda total, v: total + v.cast("double")).alias("total"),
    )


DAILY_READINGS = f"""
SELECT id, {whole('year(date)')} AS year, {whole('month(date)')} AS month, element,
       'UNKNOWN' AS dataset, {whole('COUNT(*)')} AS n_values,
       {number('MAX(value) FILTER (day(date) = 1)')} AS first_value,
       {number('MAX(value) FILTER (day(date) = 31)')} AS last_value,
       {number('SUM(CAST(value AS DOUBLE))')} AS total
FROM daily GROUP BY ALL"""


@query("a1_scan_daily", f"WITH {DAILY_CELLS} {DAILY_READINGS}")
def a1(spark, folder):
    path = encode.daily_text(spark, folder)
    readings = wl.with_values(wl.scan_daily(spark, path).readings, DAILY)
    return reading_summary(readings, "id", "year", "month", "element", "dataset")


MONTHLY_READINGS = f"""
SELECT id, {whole('year')} AS year, dataset, element, {whole('COUNT(value)')} AS n_values,
       {number('MAX(value) FILTER (month = 1)')} AS first_value,
       {number('MAX(value) FILTER (month = 12)')} AS last_value,
       {number('COALESCE(SUM(CAST(value AS DOUBLE)), 0)')} AS total
FROM monthly GROUP BY ALL"""


@query("a2_scan_monthly", f"WITH {MONTHLY_CELLS} {MONTHLY_READINGS}")
def a2(spark, folder):
    readings = wl.with_values(scanned_monthly(spark, folder), MONTHLY)
    return reading_summary(readings, "id", "year", "dataset", "element")


def station_rows(source: str) -> str:
    return f"""
SELECT substr(id, 1, 2) AS country_code, substr(id, 3, 1) AS network_code,
       substr(id, 4, 2) AS id_placeholder, substr(id, 6, 6) AS coop_id,
       {number('lat')} AS latitude, {number('lon')} AS longitude,
       {number('elevation')} AS elevation, state, name
FROM {source}"""


@query("a3_scan_monthly_network_stations", f"WITH {MONTHLY_STATIONS} {station_rows('monthly_list')}")
def a3(spark, folder):
    path = encode.station_text(spark, folder, "monthly")
    return wl.scan_stations(spark, path, "monthly_network").drop("file_name", "position")


@query("a4_scan_daily_network_stations", f"WITH {DAILY_STATIONS} {station_rows('daily_list')}")
def a4(spark, folder):
    path = encode.station_text(spark, folder, "daily")
    return wl.scan_stations(spark, path, "daily_network").drop("file_name", "position")


@query(
    "a5_scan_directory",
    f"""WITH {DAILY_CELLS} SELECT element, {whole('COUNT(*)')} AS n_lines,
        {whole('269 * COUNT(*)')} AS n_bytes, {whole('COUNT(DISTINCT id)')} AS n_stations
        FROM (SELECT DISTINCT id, date_trunc('month', date), element FROM daily_cells)
        GROUP BY element""",
)
def a5(spark, folder):
    path = encode.daily_text(spark, folder)
    raw = C.line_bytes(F.col("line"))
    lines = wl.read_lines(spark, path)
    return lines.groupBy(C.cut(raw, DAILY.element).alias("element")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(C.line_length(raw)).alias("n_bytes"),
        F.count_distinct(C.cut(raw, DAILY.id)).alias("n_stations"),
    )


@query("a6_unpack_archives", f"WITH {MONTHLY_CELLS} {MONTHLY_READINGS}")
def a6(spark, folder):
    archives = encode.monthly_archives(spark, folder)
    lines = wl.unpack_archives(archives, spread=spark.sparkContext.defaultParallelism)
    readings = wl.with_values(wl.parse_monthly(lines), MONTHLY)
    return reading_summary(readings, "id", "year", "dataset", "element")


@query(
    "a5_scan_named_files",
    f"""WITH {MONTHLY_CELLS} SELECT suffix, {whole('COUNT(*)')} AS n_lines FROM monthly_readings GROUP BY ALL""",
)
def a5_named(spark, folder):
    """Lines by what follows the station in their file's name."""
    lines = wl.read_lines(spark, encode.monthly_folder(spark, folder), recursive=True)
    suffix = F.regexp_replace("file_name", r"^[^.]*\.", "")
    return lines.groupBy(suffix.alias("suffix")).agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    "a6_run_archives",
    f"""{LOCATED_MONTHLY} SELECT *, '2025-06-27' AS snapshot_date FROM ({SPARSE_ROWS})""",
)
def a6_run(spark, folder):
    base = scratch_path(spark, "outputs")
    wl.run_monthly_archives(
        encode.monthly_archives(spark, folder), monthly_lookup(spark, folder), base, SNAPSHOT
    )
    return wl.read_monthly(spark, base).drop("dataset")


@query(
    "a7_archive_manifest",
    f"""WITH {MONTHLY_CELLS}
        SELECT 'store/hcn.' || split_part(suffix, '.', -1) || '.latest.'
               || regexp_replace(suffix, '\\.[^.]*$', '') || '.tar.gz' AS archive,
               {whole('COUNT(*)')} AS n_readings
        FROM monthly_readings GROUP BY ALL""",
)
def a7(spark, folder):
    """Each archive of the grid with the readings it would hold."""
    name = F.col("file_name")
    counts = (
        encode.monthly_lines(spark, folder)
        .groupBy(
            F.substring_index(name, ".", -1).alias("archive_element"),
            F.regexp_extract(name, r"^[^.]*\.(.*)\.[^.]*$", 1).alias("archive_dataset"),
        )
        .agg(F.count(F.lit(1)).alias("n_readings"))
    )
    manifest = wl.archive_manifest(spark, "hcn", "store")
    joined = counts.join(F.broadcast(manifest), ["archive_element", "archive_dataset"], "left")
    return joined.select("archive", "n_readings")


@query("a8_read_outputs", f"{LOCATED_MONTHLY} {SPARSE_ROWS} WHERE dataset = 'FLS52'")
def a8(spark, folder):
    base = scratch_path(spark, "outputs")
    wl.write_monthly(monthly_table(spark, folder, keep_dataset=True), base, SNAPSHOT)
    return wl.read_monthly(spark, base, "FLS52").drop("dataset", "snapshot_date")


@query(
    "a8_read_stations",
    f"""WITH {DAILY_STATIONS}, {MONTHLY_STATIONS} SELECT *, 'daily_network' AS network,
        '2025-06-27' AS snapshot_date FROM ({station_rows('daily_list')}) UNION ALL
        SELECT *, 'monthly_network', '2025-06-28' FROM ({station_rows('monthly_list')})""",
)
def a8_stations(spark, folder):
    """The newest list of each network."""
    base = scratch_path(spark, "outputs")
    for network, dates in (("daily", ("2025-06-26", SNAPSHOT)), ("monthly", (SNAPSHOT, "2025-06-28"))):
        stations = wl.scan_stations(spark, encode.station_text(spark, folder, network), f"{network}_network")
        for date in dates:
            rows = stations if date == dates[-1] else stations.filter("latitude > 40")
            wl.write_stations(rows, base, f"{network}_network", date)
    return wl.read_stations(spark, base, snapshot="latest")


@query(
    "a9_latest_snapshot",
    f"""{LOCATED_DAILY} SELECT *, '2025-06-27' AS snapshot_date FROM ({DAILY_ROWS})""",
)
def a9(spark, folder):
    base = scratch_path(spark, "outputs")
    daily = daily_table(spark, folder)
    wl.write_daily(wl.of_element(daily, "TMAX"), base, "2025-06-26")
    wl.write_daily(daily, base, SNAPSHOT)
    return wl.read_daily(spark, base, snapshot="latest")


# --- B: scalar functions ----------------------------------------------------

DAILY_HEADERS = """(SELECT DISTINCT id, strftime(date, '%Y') AS year, strftime(date, '%m') AS month,
                    element FROM daily_cells)"""


@query(
    "b01_fixed_position_substring",
    f"WITH {DAILY_CELLS} SELECT id, year, month, element FROM {DAILY_HEADERS}",
)
def b01(spark, folder):
    raw = C.line_bytes(F.col("line"))
    fields = {"id": DAILY.id, "year": DAILY.year, "month": DAILY.month, "element": DAILY.element}
    lines = encode.daily_lines(spark, folder)
    return lines.select(*[C.cut(raw, span).alias(name) for name, span in fields.items()])


@query(
    "b02_trim",
    "SELECT c_custkey, trim(repeat(' ', CAST(c_custkey % 4 AS INT)) || c_name || '  ') AS name FROM customer",
)
def b02(spark, folder):
    padded = F.concat(F.repeat(F.lit(" "), (F.col("c_custkey") % 4).cast("int")), "c_name", F.lit(" \t"))
    return table(spark, folder, "customer").select("c_custkey", C.trimmed(padded).alias("name"))


@query(
    "b03_lenient_int",
    f"""SELECT l_orderkey, l_linenumber,
        {number("CASE l_linenumber WHEN 1 THEN q WHEN 2 THEN q WHEN 3 THEN -q END")} AS parsed,
        {whole('COUNT(*)')} AS n
        FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY ALL""",
)
def b03(spark, folder):
    digits = F.col("l_quantity").cast("int").cast("string")
    form = F.col("l_linenumber")
    written = (
        F.when(form == 1, F.concat(F.lit("  "), digits, F.lit(" ")))
        .when(form == 2, F.concat(F.lit("+"), digits))
        .when(form == 3, F.concat(F.lit(" -"), digits))
        .when(form == 4, F.concat(digits, F.lit(".5")))
        .when(form == 5, F.concat(digits, F.lit(" 1")))
        .when(form == 6, F.concat(digits, F.lit("+7")))
        .otherwise("   ")
    )
    lines = table(spark, folder, "lineitem")
    parsed = lines.select(
        "l_orderkey", "l_linenumber", C.lenient_int(written).cast("double").alias("parsed")
    )
    return parsed.groupBy("l_orderkey", "l_linenumber", "parsed").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b04_lenient_float",
    f"""SELECT c_custkey, {number('CASE WHEN c_custkey % 6 IN (0, 1) THEN CAST(c_acctbal AS FLOAT) END', 2)}
        AS parsed FROM customer""",
)
def b04(spark, folder):
    digits = F.format_string("%.2f", F.col("c_acctbal"))
    form = F.col("c_custkey") % 6
    written = (
        F.when(form == 0, F.concat(F.lit("  "), digits))
        .when(form == 1, F.concat(digits, F.lit("e0 ")))
        .when(form == 2, F.lit(" -999.9 "))
        .when(form == 3, F.concat(digits, F.lit("d")))
        .when(form == 4, F.lit("  "))
        .otherwise(F.concat(digits, F.lit(" 1")))
    )
    parsed = table(spark, folder, "customer").select(
        "c_custkey", C.lenient_real(written).alias("parsed")
    )
    return shown(parsed, 2)


@query(
    "b05_blank_to_null",
    "SELECT c_custkey, CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END AS segment FROM customer",
)
def b05(spark, folder):
    written = F.when(F.col("c_nationkey") % 3 == 0, "  ").otherwise(F.concat("c_mktsegment", F.lit(" ")))
    return table(spark, folder, "customer").select("c_custkey", C.blank_to_null(written).alias("segment"))


@query(
    "b06_sentinel_to_null",
    f"""SELECT l_linenumber, {whole('COUNT(*)')} AS n_rows,
        {whole('COUNT(CASE WHEN l_quantity < 40 THEN 1 END)')} AS n_present FROM lineitem GROUP BY ALL""",
)
def b06(spark, folder):
    number_or_sentinel = F.when(F.col("l_quantity") < 40, F.col("l_partkey").cast("int")).otherwise(-9999)
    lines = table(spark, folder, "lineitem")
    return lines.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(C.sentinel_to_null(number_or_sentinel)).alias("n_present"),
    )


@query(
    "b07_unit_scaling",
    f"""SELECT o_orderkey, {number('CAST(p / 10.0 AS FLOAT)')} AS tenths,
        {number('CAST(p / 100.0 AS FLOAT)')} AS hundredths
        FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 10) AS INT) - 20000 AS p FROM orders)""",
)
def b07(spark, folder):
    raw = F.floor(F.col("o_totalprice") / 10).cast("int") - 20000
    return table(spark, folder, "orders").select(
        "o_orderkey", C.scaled(raw, 10).alias("tenths"), C.scaled(raw, 100).alias("hundredths")
    )


@query(
    "b08_element_code",
    f"""WITH {DAILY_CELLS} SELECT id, year, month, CASE WHEN element = 'SNOW' OR month = '12' THEN 'Unknown'
        ELSE element END AS element FROM {DAILY_HEADERS}""",
)
def b08(spark, folder):
    """Codes as they stand in the lines, in small letters in odd years, cut in December."""
    raw = C.line_bytes(F.col("line"))
    id, year, month, code = (C.cut(raw, s) for s in (DAILY.id, DAILY.year, DAILY.month, DAILY.element))
    code = F.when(year.cast("int") % 2 == 1, F.lower(code)).otherwise(code)
    code = F.when(month == "12", F.substring(code, 1, 3)).otherwise(code)
    return encode.daily_lines(spark, folder).select(
        id.alias("id"), year.alias("year"), month.alias("month"), C.element_code(code).alias("element")
    )


@query(
    "b09_file_properties",
    f"""WITH {MONTHLY_CELLS} SELECT id, {whole('year')} AS year,
        CASE WHEN year % 4 = 0 AND dataset <> 'FLS52' THEN 'UNKNOWN' WHEN year % 4 = 1 THEN 'UNKNOWN'
             WHEN year % 4 = 2 AND dataset <> 'FLS52' THEN 'FLS52' WHEN year % 4 = 2 THEN 'UNKNOWN'
             ELSE dataset END AS dataset,
        CASE WHEN year % 4 = 0 OR year % 4 = 1 THEN 'Unknown'
             WHEN year % 4 = 2 AND dataset = 'FLS52' THEN 'Unknown' ELSE element END AS element
        FROM monthly_readings""",
)
def b09(spark, folder):
    """Names as they are, in capitals, without their middle, or with one part more, by year."""
    name, turn = F.col("file_name"), F.col("position") % 4
    changed = (
        F.when(turn == 0, F.upper(name))
        .when(turn == 1, F.substring_index(name, ".", 1))
        .when(turn == 2, F.regexp_replace(name, r"^([^.]*)\.", "$1.x."))
        .otherwise(name)
    )
    return encode.monthly_lines(spark, folder).select(
        F.substring("file_name", 1, 11).alias("id"), F.col("position").alias("year"), *C.file_properties(changed)
    )


@query(
    "b10_element_properties",
    f"""WITH {DAILY_CELLS} SELECT 'UNKNOWN' AS dataset,
        CASE WHEN element = 'SNOW' THEN 'Unknown' ELSE element END AS element,
        {whole('COUNT(*)')} AS n FROM {DAILY_HEADERS} GROUP BY ALL""",
)
def b10(spark, folder):
    raw = C.line_bytes(F.col("line"))
    properties = C.element_properties(C.cut(raw, DAILY.element))
    lines = encode.daily_lines(spark, folder)
    return lines.groupBy(*properties).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b11_sink_label",
    f"""WITH {MONTHLY_CELLS} SELECT lower(dataset) AS label, {whole('COUNT(*)')} AS n
        FROM monthly_readings GROUP BY ALL""",
)
def b11(spark, folder):
    readings = monthly_readings(spark, folder)
    return readings.groupBy(C.sink_label(F.col("dataset")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b12_date_from_parts",
    f"""SELECT o_orderkey, {text('d')} AS date, {number("date_diff('day', DATE '1970-01-01', d)")} AS epoch_day
        FROM (SELECT o_orderkey, try_cast(printf('%04d-%02d-%02d', year(o_orderdate), o_custkey % 14,
              o_orderkey % 33) AS DATE) AS d FROM orders)""",
)
def b12(spark, folder):
    date = C.date_of(
        F.year("o_orderdate"), (F.col("o_custkey") % 14).cast("int"), (F.col("o_orderkey") % 33).cast("int")
    )
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", date.alias("date"))
        .withColumn("epoch_day", C.epoch_day(F.col("date")).cast("double"))
    )


@query("b13_station_id", f"WITH {DAILY_STATIONS} SELECT id, position FROM daily_list")
def b13(spark, folder):
    stations = wl.parse_stations(encode.daily_stations(spark, folder), "daily_network")
    parts = map(F.col, ("country_code", "network_code", "id_placeholder", "coop_id"))
    return stations.select(C.station_id(*parts).alias("id"), "position")


@query(
    "b14_value_at",
    f"""WITH {MONTHLY_CELLS} SELECT id, dataset, element, {whole('year')} AS year,
        {number('MAX(value) FILTER (month = year % 15 + 1)')} AS value FROM monthly GROUP BY ALL""",
)
def b14(spark, folder):
    readings = wl.with_values(monthly_readings(spark, folder), MONTHLY)
    value = C.value_at(F.col("values"), F.col("year") % 15)
    return readings.select("id", "dataset", "element", "year", value.alias("value"))


@query(
    "b15_line_chunks",
    f"""WITH {DAILY_CELLS} SELECT id, {text("CAST(date_trunc('month', date) AS DATE)")} AS month, element,
        {whole('day(date)')} AS slot, {DAILY_SLOT} AS chunk FROM daily_cells""",
)
def b15(spark, folder):
    """The filled slots of every daily line as text."""
    raw = F.col("raw")
    chunks = C.line_chunks(raw, DAILY.first_slot, DAILY.slot_width, DAILY.slots)
    return (
        encode.daily_lines(spark, folder)
        .select(C.line_bytes(F.col("line")).alias("raw"))
        .select(
            C.cut(raw, DAILY.id).alias("id"),
            F.concat_ws("-", C.cut(raw, DAILY.year), C.cut(raw, DAILY.month), F.lit("01")).alias("month"),
            C.cut(raw, DAILY.element).alias("element"),
            chunks.alias("chunks"),
        )
        # cut once, then exploded without the line; the outer form asks no size before
        .select("id", "month", "element", F.posexplode_outer("chunks").alias("slot", "chunk"))
        .filter(~F.col("chunk").startswith("-9999"))
        .withColumn("slot", F.col("slot") + 1)
    )


@query(
    "b16_pad_line",
    f"""WITH {MONTHLY_CELLS} SELECT r.id || '.' || r.suffix AS file_name, {whole('r.year')} AS year,
        {whole('CASE WHEN c.id IS NULL THEN 121 ELSE 124 END')} AS stripped_length,
        CAST(125 AS BIGINT) AS padded_length
        FROM monthly_readings r LEFT JOIN (SELECT * FROM monthly_cells WHERE month = 12) c
        USING (id, suffix, year)""",
)
def b16(spark, folder):
    lines = encode.monthly_lines(spark, folder)
    stripped = F.rtrim("line")
    return lines.select(
        "file_name",
        F.col("position").alias("year"),
        F.length(stripped).alias("stripped_length"),
        F.length(C.pad_line(stripped, 125)).alias("padded_length"),
    )


@query(
    "b17_station_points",
    f"""{LOCATED_DAILY} SELECT DISTINCT id, {number('lon')} AS x, {number('lat')} AS y
        FROM daily LEFT JOIN daily_lookup USING (id)""",
)
def b17(spark, folder):
    points = wl.station_points(daily_table(spark, folder))
    return points.select("id", F.col("geometry.lon").alias("x"), F.col("geometry.lat").alias("y"))


# --- C: filters -------------------------------------------------------------


@query(
    "c1_core_elements",
    f"""WITH {DAILY_CELLS} SELECT element, {whole('COUNT(*)')} AS n_rows FROM {DAILY_HEADERS}
        WHERE element IN ('PRCP', 'TMAX', 'TMIN') GROUP BY ALL""",
)
def c1(spark, folder):
    return wl.count_by(wl.parse_daily(encode.daily_lines(spark, folder), CORE_ELEMENTS), "element")


@query(
    "c1_all_elements",
    f"""WITH {DAILY_CELLS} SELECT element, {whole('COUNT(*)')} AS n_rows FROM {DAILY_HEADERS} GROUP BY ALL""",
)
def c1_all(spark, folder):
    return wl.count_by(wl.parse_daily(encode.daily_lines(spark, folder), None), "element")


@query(
    "c2_keep_all_monthly",
    f"""WITH {MONTHLY_CELLS}
        SELECT CASE WHEN element = 'Avg' THEN 'UNKNOWN' ELSE dataset END AS dataset,
               CASE WHEN element = 'Avg' THEN 'Unknown' ELSE element END AS element,
               {whole('COUNT(*)')} AS n_rows
        FROM monthly_readings GROUP BY ALL""",
)
def c2(spark, folder):
    """Readings of files with unknown names are kept."""
    path = encode.monthly_folder(spark, folder, averages_named=False)
    readings = wl.scan_monthly(spark, path, recursive=True).readings
    return wl.count_by(readings, "dataset", "element")


@query(
    "c3_drop_missing",
    f"""WITH {DAILY_CELLS} SELECT id, {whole('COUNT(*)')} AS n_rows, {text('MIN(date)')} AS first_date,
        {text('MAX(date)')} AS last_date FROM daily GROUP BY ALL""",
)
def c3(spark, folder):
    long = wl.to_daily_long(daily_readings(spark, folder))
    return long.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def spoiled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Daily lines plus one bad line in the file of each supplier in debt."""
    station = encode.hex_id("USC", F.col("s_suppkey"))
    bad = (
        table(spark, folder, "supplier")
        .filter(F.col("s_acctbal") < 2000)
        .select(
            F.concat(station, F.lit(".dly")).alias("file_name"),
            F.when(F.col("s_nationkey") % 2 == 0, F.concat(station, F.lit("19x401TMAX")))
            .otherwise(station)
            .alias("line"),
        )
    )
    return encode.daily_lines(spark, folder).unionByName(bad)


@query(
    "c4_quarantine",
    """SELECT 'USC' || lpad(hex(s_suppkey), 8, '0') || '.dly' AS file_name,
       CASE WHEN s_nationkey % 2 = 0 THEN 'bad year' ELSE 'short line' END AS reason
       FROM supplier WHERE s_acctbal < 2000""",
)
def c4_quarantine(spark, folder):
    return wl.rejected_lines(spoiled_lines(spark, folder), DAILY).select("file_name", "reason")


@query(
    "c4_drop_file",
    f"""WITH {DAILY_CELLS}, bad AS (
          SELECT 'USC' || lpad(hex(s_suppkey), 8, '0') AS id FROM supplier WHERE s_acctbal < 2000)
        SELECT id, {whole('COUNT(*)')} AS n_rows FROM {DAILY_HEADERS}
        WHERE element <> 'SNOW' AND id NOT IN (SELECT id FROM bad) GROUP BY ALL""",
)
def c4_drop_file(spark, folder):
    lines = spoiled_lines(spark, folder)
    kept, _ = wl.exclude_files(wl.parse_daily(lines), wl.rejected_files(lines, DAILY))
    return wl.count_by(kept, "id")


@query(
    "c4_run_rejects",
    """SELECT 'stations' AS kind, CAST(COUNT(*) AS BIGINT) AS n_lines
       FROM (SELECT s_suppkey % 2 AS half FROM supplier WHERE s_acctbal < 2000) HAVING COUNT(*) > 0
       UNION ALL SELECT CASE WHEN s_nationkey % 2 = 0 THEN 'bad year' ELSE 'short line' END,
       CAST(COUNT(*) AS BIGINT) FROM supplier WHERE s_acctbal < 2000 GROUP BY ALL""",
)
def c4_run(spark, folder):
    """What complete runs report: short station lines, and bad lines of the stream."""
    text = encode.stored(
        spark, folder, "spoiled-text", lambda: spoiled_lines(spark, folder), as_text=True
    )
    cut = encode.stored(
        spark, folder, "spoiled-stations",
        lambda: spoiled_lines(spark, folder).filter(F.length("line") < 40), as_text=True,
    )
    base = scratch_path(spark, "outputs")
    stations = wl.run_stations(spark, cut, "daily_network", base, SNAPSHOT)
    run = wl.append_with_rejects(
        wl.landing_lines(spark, text), daily_lookup(spark, folder), f"{base}/daily-stream",
        f"{base}/rejects", f"{base}/state",
    )
    run.awaitTermination()
    lines = wl.count_by(spark.read.parquet(f"{base}/rejects"), "reason")
    short = stations.rejects.groupBy(F.lit("stations").alias("kind")).agg(F.count(F.lit(1)).alias("n_lines"))
    return short.union(lines.select("reason", "n_rows"))


@query("c5_element_filter", f"{LOCATED_DAILY} {DAILY_ROWS} WHERE element = 'TMAX'")
def c5(spark, folder):
    return wl.of_element(daily_table(spark, folder), "TMAX")


@query(
    "c6_bounding_box",
    f"""{LOCATED_DAILY} {DAILY_ROWS} WHERE lat BETWEEN CAST(30 AS FLOAT) AND CAST(45 AS FLOAT)
        AND lon BETWEEN CAST(-100 AS FLOAT) AND CAST(-80 AS FLOAT)""",
)
def c6(spark, folder):
    return wl.within_bbox(daily_table(spark, folder), 30.0, 45.0, -100.0, -80.0)


@query(
    "c7_complete_rows",
    f"""{LOCATED_MONTHLY} SELECT id, {text('date')} AS date, {number('value')} AS max_raw,
        {number('lat')} AS lat, {number('lon')} AS lon
        FROM monthly JOIN monthly_lookup USING (id)
        WHERE element = 'Max' AND dataset = 'RAW' AND value IS NOT NULL""",
)
def c7(spark, folder):
    return wl.complete_rows(monthly_table(spark, folder), ["id", "date", "max_raw", "lat", "lon"])


@query(
    "c8_complete_coordinates",
    f"""WITH {DAILY_STATIONS} {station_rows('daily_list')} WHERE lat IS NOT NULL AND lon IS NOT NULL""",
)
def c8(spark, folder):
    stations = wl.parse_stations(encode.daily_stations(spark, folder), "daily_network")
    return wl.complete_coordinates(stations).drop("position")


@query(
    "c9_skip_empty_groups",
    f"""WITH {MONTHLY_CELLS} SELECT lower(dataset) AS dataset, {whole('12 * COUNT(*)')} AS n_rows
        FROM monthly_readings WHERE dataset <> 'TOB' GROUP BY ALL""",
)
def c9(spark, folder):
    """No output folder for a dataset without readings."""
    base = scratch_path(spark, "outputs")
    sparse = monthly_table(spark, folder, keep_dataset=True)
    wl.write_monthly(sparse.filter(F.col("dataset") != "TOB"), base, SNAPSHOT)
    return wl.count_by(wl.read_monthly(spark, base), "dataset")


# --- D: joins ---------------------------------------------------------------


@query(
    "d1_inject_coords_daily",
    f"""{LOCATED_DAILY} SELECT h.id, h.year, h.month, h.element, {number('lat')} AS lat, {number('lon')} AS lon
        FROM (SELECT id, {whole('year')} AS year, {whole('month')} AS month, element FROM {DAILY_HEADERS}) h
        LEFT JOIN daily_lookup USING (id) WHERE element <> 'SNOW'""",
)
def d1_daily(spark, folder):
    located = wl.inject_coords(daily_readings(spark, folder), daily_lookup(spark, folder))
    return located.select("id", "year", "month", "element", "lat", "lon")


@query(
    "d1_inject_coords_monthly",
    f"""{LOCATED_MONTHLY} SELECT id, {whole('year')} AS year, dataset, element, {number('lat')} AS lat,
        {number('lon')} AS lon FROM monthly_readings LEFT JOIN monthly_lookup USING (id)""",
)
def d1_monthly(spark, folder):
    located = wl.inject_coords(monthly_readings(spark, folder), monthly_lookup(spark, folder))
    return located.select("id", "year", "dataset", "element", "lat", "lon")


@query(
    "d2_station_lookup",
    f"""WITH {DAILY_STATIONS} SELECT id, {number('lat')} AS lat, {number('lon')} AS lon FROM daily_lookup""",
)
def d2(spark, folder):
    return build_daily_lookup(spark, folder)


@query(
    "d2_lookup_over_two_lists",
    f"""WITH {DAILY_STATIONS} SELECT id, {number('lat')} AS lat, {number('lon')} AS lon FROM daily_list
        WHERE lat IS NOT NULL AND lon IS NOT NULL QUALIFY row_number() OVER (
          PARTITION BY id ORDER BY CAST(position % 2 = 0 AS INT) DESC, position DESC) = 1""",
)
def d2_two(spark, folder):
    """The last list wins, whatever the sizes of the files."""
    lists = encode.two_station_lists(spark, folder)
    return wl.station_lookup(wl.scan_stations(spark, lists, "daily_network"))


def comparison(element: str) -> str:
    return f"""WITH {MONTHLY_CELLS}
    SELECT id, {text('a.date')} AS date, {number('a.value')} AS {element.lower()}_raw,
           {number('b.value')} AS {element.lower()}_fls52, {number('b.value - a.value')} AS difference
    FROM monthly a JOIN monthly b USING (id, element, year, month)
    WHERE element = '{element}' AND a.dataset = 'RAW' AND b.dataset = 'FLS52'
      AND a.value IS NOT NULL AND b.value IS NOT NULL"""


@query("d3_compare_quality", comparison("Max"))
def d3(spark, folder):
    return wl.compare_quality(wl.to_monthly_sparse(monthly_readings(spark, folder)), "max")


@query("d3_compare_quality_min", comparison("Min"))
def d3_min(spark, folder):
    return wl.compare_quality(wl.to_monthly_sparse(monthly_readings(spark, folder)), "min")


# --- E: reshape -------------------------------------------------------------


@query("e1_daily_long", f"{LOCATED_DAILY} {DAILY_ROWS}")
def e1(spark, folder):
    return daily_table(spark, folder)


@query("e2_monthly_sparse", f"{LOCATED_MONTHLY} {SPARSE_ROWS}")
def e2(spark, folder):
    return monthly_table(spark, folder)


@query(
    "e3_monthly_wide",
    f"""{LOCATED_MONTHLY} SELECT id, {text('date')} AS date, {WIDE_COLUMNS}, {number('lat')} AS lat,
        {number('lon')} AS lon FROM monthly LEFT JOIN monthly_lookup USING (id)
        GROUP BY id, date, lat, lon""",
)
def e3(spark, folder):
    return wl.to_monthly_wide(monthly_table(spark, folder))


# --- F: aggregations --------------------------------------------------------


@query(
    "f1_readings_per_dataset",
    f"""WITH {MONTHLY_CELLS} SELECT dataset, {whole('COUNT(*)')} AS n_readings
        FROM monthly_readings GROUP BY ALL""",
)
def f1(spark, folder):
    return wl.reading_counts(monthly_readings(spark, folder))


@query(
    "f2_output_rows",
    f"""WITH {DAILY_CELLS} SELECT
        {whole(f"(SELECT COUNT(*) FROM {DAILY_HEADERS} WHERE element <> 'SNOW')")} AS n_readings,
        {whole('(SELECT COUNT(*) FROM daily)')} AS n_rows""",
)
def f2(spark, folder):
    """Readings and long rows of a run, counted while the rows are written."""
    base = scratch_path(spark, "outputs")
    path = encode.daily_text(spark, folder)
    run = wl.run_daily(spark, path, daily_lookup(spark, folder), base, SNAPSHOT)
    return wl.read_daily(spark, base).agg(
        F.lit(run.readings["UNKNOWN"]).alias("n_readings"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "f3_value_count",
    f"""WITH {DAILY_CELLS} SELECT {whole('(SELECT COUNT(*) FROM daily)')} AS n_values,
        {whole(f"(SELECT 31 * COUNT(*) FROM {DAILY_HEADERS} WHERE element <> 'SNOW')")} AS n_slots""",
)
def f3(spark, folder):
    return wl.value_count(daily_readings(spark, folder), DAILY)


def mean_sql(element: str) -> str:
    return f"""WITH {DAILY_CELLS}, means AS (
      SELECT last_day(date) AS month, AVG(CAST(value AS DOUBLE)) AS mean_value
      FROM daily WHERE element = '{element}' GROUP BY ALL),
    calendar AS (
      SELECT last_day(CAST(unnest(generate_series((SELECT date_trunc('month', MIN(month)) FROM means),
             (SELECT MAX(month) FROM means), INTERVAL 1 MONTH)) AS DATE)) AS month)
    SELECT {text('month')} AS month, {number('mean_value', 6)} AS mean_value
    FROM calendar LEFT JOIN means USING (month)"""


@query("f4_monthly_mean", mean_sql("TMAX"))
def f4(spark, folder):
    return wl.monthly_mean(wl.to_daily_long(daily_readings(spark, folder)), "TMAX")


@query(
    "f4_monthly_mean_with_gaps",
    f"""WITH cells AS (SELECT last_day(CAST(ts AS DATE)) AS month, user_id, value FROM events
          UNION ALL SELECT last_day(CAST(o_orderdate AS DATE)), o_custkey, o_totalprice FROM orders),
        means AS (SELECT month, AVG(CAST(CAST(floor(value) AS FLOAT) AS DOUBLE)) AS mean_value
          FROM cells GROUP BY ALL),
        calendar AS (
          SELECT last_day(CAST(unnest(generate_series((SELECT date_trunc('month', MIN(month)) FROM means),
             (SELECT MAX(month) FROM means), INTERVAL 1 MONTH)) AS DATE)) AS month)
        SELECT {text('month')} AS month, {number('mean_value', 6)} AS mean_value
        FROM calendar LEFT JOIN means USING (month)""",
)
def f4_gaps(spark, folder):
    """Orders end years before the events begin: the months between are null."""
    value = F.floor("value").cast("float").alias("value")
    events = table(spark, folder, "events").select(F.col("ts").cast("date").alias("date"), value)
    orders = (
        table(spark, folder, "orders")
        .withColumnRenamed("o_totalprice", "value")
        .select(F.col("o_orderdate").cast("date").alias("date"), value)
    )
    return wl.monthly_mean(events.unionByName(orders))


@query(
    "f5_coordinate_coverage",
    f"""{LOCATED_DAILY} SELECT {whole('COUNT(*)')} AS n_rows, {whole('COUNT(lat)')} AS with_coordinates,
        {number('COUNT(lat) * 100.0 / COUNT(*)')} AS percent FROM daily LEFT JOIN daily_lookup USING (id)""",
)
def f5(spark, folder):
    return wl.coordinate_coverage(daily_table(spark, folder))


@query(
    "f6_station_coordinates",
    f"""{LOCATED_DAILY} SELECT DISTINCT id, {number('lat')} AS lat, {number('lon')} AS lon
        FROM daily LEFT JOIN daily_lookup USING (id)""",
)
def f6(spark, folder):
    return wl.station_coordinates(daily_table(spark, folder))


@query(
    "f7_profile_monthly",
    f"""WITH {MONTHLY_CELLS} SELECT {whole('COUNT(DISTINCT id)')} AS n_stations,
        {whole('COUNT(DISTINCT year)')} AS n_years, {whole('MIN(year)')} AS first_year,
        {whole('MAX(year)')} AS last_year FROM monthly_readings""",
)
def f7(spark, folder):
    return wl.profile_monthly(encode.monthly_lines(spark, folder))


@query(
    "f8_file_statistics",
    f"""WITH {MONTHLY_CELLS} SELECT id || '.' || suffix AS file_name, {whole('COUNT(*)')} AS n_lines,
        CAST(124 AS BIGINT) AS first_line_length FROM monthly_readings GROUP BY ALL""",
)
def f8(spark, folder):
    return wl.file_statistics(encode.monthly_lines(spark, folder))


@query(
    "f8_archive_statistics",
    f"""WITH {MONTHLY_CELLS} SELECT id || '.' || suffix AS file_name, {whole('COUNT(*)')} AS n_lines,
        CAST(124 AS BIGINT) AS first_line_length FROM monthly_readings GROUP BY ALL""",
)
def f8_archives(spark, folder):
    return wl.file_statistics(wl.unpack_archives(encode.monthly_archives(spark, folder)))


@query(
    "f9_element_counts",
    f"WITH {DAILY_CELLS} SELECT element, {whole('COUNT(*)')} AS n_rows FROM daily GROUP BY ALL",
)
def f9(spark, folder):
    return wl.count_by(wl.to_daily_long(daily_readings(spark, folder)), "element")


# --- G: integrity -----------------------------------------------------------


def rules_sql(source: str, rules: list[tuple[str, str, str]]) -> str:
    """Expected report: (rule, condition of checked rows, condition of violations)."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, {whole(f'COUNT(*) FILTER ({checked})')} AS checked, "
        f"{whole(f'COUNT(*) FILTER ({violated})')} AS violations FROM {source}"
        for name, checked, violated in rules
    )


def range_sql(column: str, low: float, high: float) -> tuple[str, str, str]:
    return (
        f"{column} in [{low:g}, {high:g}]",
        f"{column} IS NOT NULL",
        f"{column} IS NOT NULL AND {column} NOT BETWEEN {low} AND {high}",
    )


def present_sql(column: str) -> tuple[str, str, str]:
    return (f"{column} is present", "true", f"{column} IS NULL")


CHECKED_DAILY = """checked_daily AS (
  SELECT id, date, element, 'UNKNOWN' AS dataset, value, lat, lon
  FROM daily LEFT JOIN daily_lookup USING (id))"""
CHECKED_MONTHLY = f"""checked_monthly AS (
  SELECT id, date, {', '.join(f'{measure(name)} AS {name}' for name in MEASURE_NAMES)}, lat, lon
  FROM monthly LEFT JOIN monthly_lookup USING (id))"""
DAILY_REPORT = [
    *map(present_sql, ("id", "date", "element", "dataset", "value", "lat")),
    (
        "temperature in [-50, 60]",
        "element IN ('TMAX', 'TMIN')",
        "element IN ('TMAX', 'TMIN') AND value NOT BETWEEN -50 AND 60",
    ),
    range_sql("lat", 18, 71),
    range_sql("lon", -178, -65),
]
MONTHLY_REPORT = [
    present_sql("id"),
    present_sql("lat"),
    *[range_sql(name, -50, 60) for name in MEASURE_NAMES],
    ("date is the first of a month", "date IS NOT NULL", "day(date) <> 1"),
    range_sql("lat", 21, 69),
    range_sql("lon", -158, -65),
]


@query(
    "g1_coordinates_present",
    f"{LOCATED_DAILY}, {CHECKED_DAILY} {rules_sql('checked_daily', [present_sql('lat')])}",
)
def g1(spark, folder):
    return wl.check_integrity(daily_table(spark, folder), [wl.not_null("lat")])


@query(
    "g2_temperature_range",
    f"""WITH {monthly_cells(1000)}, {MONTHLY_STATIONS}, {CHECKED_MONTHLY.replace('value', '(value * 2)')}
        {rules_sql('checked_monthly', [range_sql(name, -50, 60) for name in MEASURE_NAMES])}""",
)
def g2(spark, folder):
    """Values are doubled, so that some leave the range."""
    sparse = wl.to_monthly_sparse(monthly_readings(spark, folder, 1000))
    doubled = sparse.select(*[(F.col(name) * 2).alias(name) for name in MEASURES])
    return wl.check_integrity(doubled, temperature_rules())


@query(
    "g3_first_of_month",
    f"""WITH {DAILY_CELLS} {rules_sql('daily', [("date is the first of a month", "date IS NOT NULL", "day(date) <> 1")])}""",
)
def g3(spark, folder):
    long = wl.to_daily_long(daily_readings(spark, folder))
    return wl.check_integrity(long, [wl.first_of_month()])


@query(
    "g5_coordinate_ranges",
    f"""{LOCATED_DAILY}, {CHECKED_DAILY}
        {rules_sql('checked_daily', [range_sql('lat', 30, 40), range_sql('lon', -110, -90)])}""",
)
def g5(spark, folder):
    """A narrower box than the real one, so that some stations leave it."""
    rules = [wl.in_range("lat", 30.0, 40.0), wl.in_range("lon", -110.0, -90.0)]
    return wl.check_integrity(daily_table(spark, folder), rules)


@query(
    "g6_required_columns",
    f"""{LOCATED_DAILY}, {CHECKED_DAILY}
        {rules_sql('checked_daily', [present_sql(c) for c in DAILY_REQUIRED])}""",
)
def g6(spark, folder):
    return wl.check_integrity(daily_table(spark, folder), required(DAILY_REQUIRED))


@query(
    "g_daily_report", f"{LOCATED_DAILY}, {CHECKED_DAILY} {rules_sql('checked_daily', DAILY_REPORT)}"
)
def g_daily(spark, folder):
    return wl.check_integrity(daily_table(spark, folder), wl.daily_rules())


@query(
    "g_monthly_report",
    f"{LOCATED_MONTHLY}, {CHECKED_MONTHLY} {rules_sql('checked_monthly', MONTHLY_REPORT)}",
)
def g_monthly(spark, folder):
    return wl.check_integrity(monthly_table(spark, folder), wl.monthly_rules())


STATION_REPORT = [
    present_sql(name) for name in ("country_code", "network_code", "id_placeholder", "coop_id", "name")
]


@query(
    "g_station_report",
    f"WITH {DAILY_STATIONS}, stations AS ({station_rows('daily_list')}) {rules_sql('stations', STATION_REPORT)}",
)
def g_stations(spark, folder):
    stations = wl.scan_stations(spark, encode.station_text(spark, folder, "daily"), "daily_network")
    return wl.check_integrity(stations, wl.station_rules())


# --- H: samples -------------------------------------------------------------

SAMPLED = f"WITH {MONTHLY_CELLS}, {MONTHLY_TEXT}"


@query(
    "h1_sample_lines",
    f"""{SAMPLED} SELECT file_name, {whole('year')} AS position, line FROM monthly_line
        ORDER BY file_name, year LIMIT 100""",
)
def h1(spark, folder):
    return wl.sample_lines(encode.monthly_lines(spark, folder), 100)


@query(
    "h1_first_lines",
    f"""{SAMPLED} SELECT substr(file_name, 1, 7) || '0000' || substr(file_name, 12) AS file_name, line
        FROM monthly_line ORDER BY 1, 2 LIMIT 100""",
)
def h1_first(spark, folder):
    """From the first files of a folder only."""
    return wl.first_lines(spark, encode.monthly_folder(spark, folder), 100).drop("position")


@query(
    "h1_profile_first_lines",
    f"""WITH {MONTHLY_CELLS}, sample AS (
          SELECT * FROM monthly_readings ORDER BY id || '.' || suffix, year LIMIT 100)
        SELECT {whole('COUNT(DISTINCT id)')} AS n_stations, {whole('COUNT(DISTINCT year)')} AS n_years,
        {whole('MIN(year)')} AS first_year, {whole('MAX(year)')} AS last_year FROM sample""",
)
def h1_profile(spark, folder):
    return wl.profile_monthly(encode.monthly_lines(spark, folder), first_lines=100)


@query(
    "h2_first_matching_file",
    f"""{SAMPLED} SELECT file_name, {whole('year')} AS position, line FROM monthly_line
        WHERE file_name = (SELECT MIN(file_name) FROM monthly_line WHERE file_name LIKE '%.tmin')""",
)
def h2(spark, folder):
    return wl.first_file_lines(encode.monthly_lines(spark, folder), "tmin")


@query(
    "h3_explain_layout",
    f"""{SAMPLED} SELECT file_name, {text('year')} AS year, id, {whole('month')} AS slot, chunk
        FROM monthly_text""",
)
def h3(spark, folder):
    return wl.explain_layout(encode.monthly_lines(spark, folder)).drop("position")


# --- I: sinks ---------------------------------------------------------------


@query("i1_write_daily", f"{LOCATED_DAILY} {DAILY_ROWS}")
def i1(spark, folder):
    path = wl.write_daily(daily_table(spark, folder), scratch_path(spark, "outputs"), SNAPSHOT)
    return spark.read.parquet(path)


@query(
    "i2_write_monthly",
    f"""{LOCATED_MONTHLY} SELECT *, '2025-06-27' AS snapshot_date FROM (
        SELECT id, {text('date')} AS date, {SPARSE_COLUMNS}, {number('lat')} AS lat, {number('lon')} AS lon,
        lower(dataset) AS dataset FROM monthly LEFT JOIN monthly_lookup USING (id))""",
)
def i2(spark, folder):
    base = scratch_path(spark, "outputs")
    files = f"{encode.monthly_folder(spark, folder)}/*"
    wl.run_monthly(spark, files, monthly_lookup(spark, folder), base, SNAPSHOT)
    return wl.read_monthly(spark, base)


@query(
    "i3_write_stations",
    f"""WITH {DAILY_STATIONS} SELECT *, 'daily_network' AS network, '2025-06-27' AS snapshot_date
        FROM ({station_rows('daily_list')})""",
)
def i3(spark, folder):
    base = scratch_path(spark, "outputs")
    stations = wl.parse_stations(encode.daily_stations(spark, folder), "daily_network")
    wl.write_stations(stations, base, "daily_network", SNAPSHOT)
    return wl.read_stations(spark, base)


@query(
    "i4_rerun_replaces_snapshot",
    f"""WITH {DAILY_CELLS} SELECT snapshot_date, {whole('COUNT(*)')} AS n_rows
        FROM daily CROSS JOIN (VALUES ('2025-06-26'), ('2025-06-27')) AS s(snapshot_date) GROUP BY ALL""",
)
def i4(spark, folder):
    base = scratch_path(spark, "outputs")
    daily = daily_table(spark, folder)
    for date in ("2025-06-26", SNAPSHOT, SNAPSHOT):
        wl.write_daily(daily, base, date)
    return wl.count_by(wl.read_daily(spark, base), "snapshot_date")


@query(
    "i4_rerun_without_a_dataset",
    f"""WITH {MONTHLY_CELLS} SELECT lower(dataset) AS dataset, snapshot_date, {whole('12 * COUNT(*)')} AS n_rows
        FROM monthly_readings JOIN (VALUES ('2025-06-26'), ('2025-06-27')) AS s(snapshot_date)
        ON snapshot_date = '2025-06-26' OR dataset <> 'TOB' GROUP BY ALL""",
)
def i4_dataset(spark, folder):
    """A snapshot written again without a dataset has no rows of it."""
    base = scratch_path(spark, "outputs")
    sparse = monthly_table(spark, folder, keep_dataset=True)
    for date in ("2025-06-26", SNAPSHOT):
        wl.write_monthly(sparse, base, date)
    wl.write_monthly(sparse.filter(F.col("dataset") != "TOB"), base, SNAPSHOT)
    return wl.count_by(wl.read_monthly(spark, base), "dataset", "snapshot_date")


# --- J: stream --------------------------------------------------------------


@query("j1_stream_daily", f"{LOCATED_DAILY} {DAILY_ROWS}")
def j1(spark, folder):
    landing = encode.daily_text(spark, folder)
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    stream = wl.stream_daily(wl.landing_lines(spark, landing), daily_lookup(spark, folder))
    wl.append_daily(stream, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


# --- X: checks of the format documents --------------------------------------

FLAGGED = """
SELECT id, date, element, value, CASE WHEN line = 1 THEN 'T' ELSE '' END AS mflag,
       CASE WHEN line >= 6 THEN 'X' ELSE '' END AS qflag, substr('ZRD06CX', CAST(line AS INT), 1) AS sflag
FROM daily JOIN daily_cells USING (id, date, element)"""


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    return wl.to_daily_long(daily_readings(spark, folder), flags=True)


@query(
    "x1_daily_flags",
    f"""WITH {DAILY_CELLS} SELECT id, {text('date')} AS date, element, {number('value')} AS value,
        mflag, qflag, sflag FROM ({FLAGGED})""",
)
def x1(spark, folder):
    return flagged(spark, folder).drop("dataset", "lat", "lon")


@query(
    "x2_monthly_flags",
    f"""WITH {MONTHLY_CELLS} SELECT id, {text('date')} AS date, dataset, element, {number('value')} AS value,
        CASE WHEN flag IS NULL THEN '' ELSE substr('abcde', CAST(flag AS INT), 1) END AS dmflag,
        CASE WHEN flag = 5 THEN 'D' ELSE '' END AS qcflag, COALESCE({text('flag')}, '') AS dsflag
        FROM monthly""",
)
def x2(spark, folder):
    long = wl.to_monthly_long(monthly_readings(spark, folder), flags=True)
    return long.drop("lat", "lon")


@query(
    "x3_quality_filter",
    f"""WITH {DAILY_CELLS} SELECT id, {text('date')} AS date, element, {number('value')} AS value
        FROM ({FLAGGED}) WHERE qflag = ''""",
)
def x3(spark, folder):
    return wl.passed_quality(flagged(spark, folder)).select("id", "date", "element", "value")


WIDE_CTE = f"""wide AS (
  SELECT id, date, {', '.join(f'MAX({measure(name)}) AS {name}' for name in MEASURE_NAMES)}
  FROM monthly GROUP BY ALL)"""


@query(
    "x4_inconsistent_months",
    f"""WITH {MONTHLY_CELLS}, {WIDE_CTE} SELECT id, {text('date')} AS date, {number('min_raw')} AS min_raw,
        {number('max_raw')} AS max_raw FROM wide WHERE min_raw > max_raw""",
)
def x4(spark, folder):
    wide = wl.to_monthly_wide(wl.to_monthly_sparse(monthly_readings(spark, folder)))
    return wl.inconsistent_months(wide)


@query(
    "x5_isolated_values",
    f"""WITH {MONTHLY_CELLS}, numbered AS (
          SELECT *, year * 12 + month AS n FROM monthly WHERE value IS NOT NULL)
        SELECT id, dataset, element, {text('date')} AS date, {number('value')} AS value FROM numbered a
        WHERE NOT EXISTS (SELECT 1 FROM numbered b WHERE b.id = a.id AND b.dataset = a.dataset
          AND b.element = a.element AND b.n <> a.n AND abs(b.n - a.n) <= 18)""",
)
def x5(spark, folder):
    return wl.isolated_values(wl.to_monthly_long(monthly_readings(spark, folder)))


@query(
    "x6_duplicate_years",
    f"""WITH {monthly_cells(250000)}, series AS (
          SELECT id, dataset, element, year, list(value ORDER BY month) AS vals, COUNT(value) AS n
          FROM monthly GROUP BY ALL)
        SELECT id, dataset, element, {whole('COUNT(*)')} AS n_years, {whole('MIN(year)')} AS first_year,
        {whole('MAX(year)')} AS last_year FROM series WHERE n > 0
        GROUP BY id, dataset, element, vals HAVING COUNT(*) > 1""",
)
def x6(spark, folder):
    """On values in coarse steps, so that some years are equal."""
    return wl.duplicate_years(monthly_readings(spark, folder, 250000))


@query(
    "x7_best_source",
    f"""WITH {DAILY_CELLS}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY id, date ORDER BY line, value DESC) AS r
          FROM daily JOIN daily_cells USING (id, date, element))
        SELECT id, {text('date')} AS date, {number('value')} AS value,
        substr('ZRD06CX', CAST(line AS INT), 1) AS sflag FROM ranked WHERE r = 1""",
)
def x7(spark, folder):
    """Elements compete here, which gives several sources per station and day."""
    return wl.best_source(flagged(spark, folder), keys=("id", "date")).select("id", "date", "value", "sflag")


@query(
    "x7_best_source_default",
    f"""WITH {DAILY_CELLS}, flagged AS ({FLAGGED}), twice AS (
          SELECT * FROM flagged UNION ALL
          SELECT id, date, element, CAST(value + 1 AS FLOAT), mflag, 'S', translate(sflag, 'ZRD06CX', 'X6ZRDC0')
          FROM flagged),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id, date, element
          ORDER BY strpos('ZRD06CX', sflag), value DESC) AS r FROM twice)
        SELECT id, {text('date')} AS date, element, 'UNKNOWN' AS dataset, {number('value')} AS value,
        mflag, qflag, sflag FROM ranked WHERE r = 1""",
)
def x7_default(spark, folder):
    """Every value and a copy of it from another source; the row comes out whole."""
    own = flagged(spark, folder)
    other = own.withColumns(
        {
            "value": (F.col("value") + 1).cast("float"),
            "qflag": F.lit("S"),
            "sflag": F.translate("sflag", "ZRD06CX", "X6ZRDC0"),
        }
    )
    return wl.best_source(own.unionByName(other)).drop("lat", "lon")


@query(
    "x8_average_from_extremes",
    f"""WITH {MONTHLY_CELLS}, {WIDE_CTE} SELECT id, {text('date')} AS date,
        {number('CAST((max_raw + min_raw) / 2 AS FLOAT)')} AS avg_raw_computed FROM wide""",
)
def x8(spark, folder):
    wide = wl.to_monthly_wide(wl.to_monthly_sparse(monthly_readings(spark, folder)))
    return wl.average_from_extremes(wide).select("id", "date", "avg_raw_computed")


# --- X9 to X14: checks that look at neighbours, distributions and series ------

BIWEIGHT_SQL = """
medians AS (
  SELECT *, median(x) OVER w AS m, COUNT(*) OVER w AS n_values FROM cells
  WINDOW w AS (PARTITION BY id, dataset, element, month(date))
), spreads AS (
  SELECT *, median(abs(x - m)) OVER (PARTITION BY id, dataset, element, month(date)) AS d FROM medians
), weights AS (
  SELECT *, CASE WHEN d > 0 AND n_values >= {least} THEN pow((x - m) / (7.5 * d), 2) END AS u2 FROM spreads
), estimates AS (
  SELECT *, m + SUM((x - m) * pow(1 - u2, 2)) FILTER (u2 < 1) OVER w
              / SUM(pow(1 - u2, 2)) FILTER (u2 < 1) OVER w AS mean,
         sqrt(n_values * SUM(pow(x - m, 2) * pow(1 - u2, 4)) FILTER (u2 < 1) OVER w)
              / abs(SUM((1 - u2) * (1 - 5 * u2)) FILTER (u2 < 1) OVER w) AS deviation
  FROM weights WINDOW w AS (PARTITION BY id, dataset, element, month(date))
), scores AS (
  SELECT *, (x - mean) / CASE WHEN deviation <> 0 THEN deviation END AS score FROM estimates
)"""
MONTHLY_BIWEIGHT = f"""WITH {MONTHLY_CELLS}, cells AS (
  SELECT id, dataset, element, date, MAX(CAST(value AS DOUBLE)) AS x FROM monthly
  WHERE value IS NOT NULL GROUP BY ALL), {BIWEIGHT_SQL.format(least=3)}"""


@query(
    "x9_biweight_scores",
    f"""{MONTHLY_BIWEIGHT} SELECT id, dataset, element, {text('date')} AS date, {number('x')} AS value,
        {whole('n_values')} AS n_values, {number('mean', 6)} AS mean, {number('deviation')} AS deviation,
        {number('score')} AS score FROM scores""",
)
def x9(spark, folder):
    return wl.biweight_scores(wl.to_monthly_long(monthly_readings(spark, folder)), min_values=3)


@query(
    "x9_biweight_outliers",
    f"""{MONTHLY_BIWEIGHT} SELECT id, dataset, element, {text('date')} AS date, {number('x')} AS value,
        {number('score')} AS score FROM scores WHERE abs(score) >= 5""",
)
def x9_outliers(spark, folder):
    long = wl.to_monthly_long(monthly_readings(spark, folder))
    return wl.biweight_outliers(long, min_values=3).drop("n_values", "mean", "deviation")


NEIGHBOUR_SQL = """
points AS (
  SELECT id, 6371 * cos(radians(lat)) * cos(radians(lon)) AS x,
         6371 * cos(radians(lat)) * sin(radians(lon)) AS y, 6371 * sin(radians(lat)) AS z
  FROM (SELECT id, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM {lookup})
), distances AS (
  SELECT a.id, b.id AS neighbour, 2 * 6371 * asin(least(1,
         sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) / (2 * 6371))) AS distance_km
  FROM points a JOIN points b ON a.id <> b.id
), nearest AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance_km, neighbour) AS rank
  FROM distances WHERE distance_km <= {within} QUALIFY rank <= 5
)"""


@query(
    "x10_nearest_stations",
    f"""WITH {DAILY_STATIONS}, {NEIGHBOUR_SQL.format(lookup='daily_lookup', within=500)}
        SELECT id, {whole('rank')} AS rank, neighbour, {number('distance_km')} AS distance_km FROM nearest""",
)
def x10_nearest(spark, folder):
    return wl.nearest_stations(daily_lookup(spark, folder))


@query(
    "x10_spatial_outliers",
    f"""WITH {MONTHLY_CELLS}, {MONTHLY_STATIONS}, cells AS (
          SELECT id, 'RAW' AS dataset, 'Max' AS element, date, MAX(CAST(value AS DOUBLE)) AS x FROM monthly
          WHERE value IS NOT NULL GROUP BY ALL), {BIWEIGHT_SQL.format(least=3)},
        {NEIGHBOUR_SQL.format(lookup='monthly_lookup', within=1000)}, judged AS (
          SELECT s.id, s.dataset, s.element, s.date, ANY_VALUE(s.x) AS value, ANY_VALUE(s.score) AS score,
                 COUNT(o.score) AS n_neighbours, MAX(o.score * sign(s.score)) AS best_score
          FROM scores s JOIN nearest USING (id) JOIN scores o ON o.id = neighbour AND o.date = s.date
          WHERE abs(s.score) >= 2.5 AND abs(s.score) < 5 AND o.score IS NOT NULL GROUP BY ALL)
        SELECT id, dataset, element, {text('date')} AS date, {number('value')} AS value,
        {number('score')} AS score, {whole('n_neighbours')} AS n_neighbours,
        {number('best_score')} AS best_score FROM judged
        WHERE best_score < CASE WHEN abs(score) >= 4 THEN 1.9 WHEN abs(score) >= 3 THEN 1.8
                                WHEN abs(score) >= 2.75 THEN 1.7 ELSE 1.6 END""",
)
def x10(spark, folder):
    """All elements of a station as one, so that its months have enough values."""
    long = wl.to_monthly_long(monthly_readings(spark, folder))
    long = long.withColumns({"dataset": F.lit("RAW"), "element": F.lit("Max")})
    return wl.spatial_outliers(long, monthly_lookup(spark, folder), within_km=1000.0, min_values=3)


CLIMATE_SQL = f"""WITH {DAILY_CELLS}, days AS (
  SELECT *, dayofyear(make_date(2000, month(date), day(date))) AS own,
         CAST(round(CAST(value AS DOUBLE) * 10) AS BIGINT) AS t FROM daily
), single AS (
  SELECT id, element, own, COUNT(*) AS n, SUM(t) AS s, SUM(t * t) AS q FROM days GROUP BY ALL
), sums AS (
  SELECT id, element, (own + step + 365) % 366 + 1 AS day, SUM(n) AS n, SUM(s) AS s, SUM(q) AS q
  FROM single CROSS JOIN (SELECT unnest(range(-7, 8)) AS step) GROUP BY ALL
), climate AS (
  SELECT id, element, day, n AS n_values, CAST(s AS DOUBLE) / n / 10 AS mean, CASE WHEN n > 1 THEN
         sqrt(greatest((CAST(q AS DOUBLE) - CAST(s AS DOUBLE) * s / n) / (n - 1), 0)) / 10 END AS deviation
  FROM sums
)"""


@query(
    "x11_daily_climate",
    f"""{CLIMATE_SQL} SELECT id, element, {whole('day')} AS day, {whole('n_values')} AS n_values,
        {number('mean', 6)} AS mean, {number('deviation')} AS deviation FROM climate""",
)
def x11_climate(spark, folder):
    return wl.daily_climate(daily_table(spark, folder))


@query(
    "x11_climate_outliers",
    f"""{CLIMATE_SQL} SELECT id, element, {text('date')} AS date, {number('value')} AS value,
        {whole('n_values')} AS n_values, {number('mean', 6)} AS mean, {number('deviation')} AS deviation,
        {number('(CAST(value AS DOUBLE) - mean) / deviation')} AS score
        FROM days JOIN climate c USING (id, element)
        WHERE c.day = days.own AND n_values >= 5 AND deviation > 0
          AND abs((CAST(value AS DOUBLE) - mean) / deviation) >= 2""",
)
def x11(spark, folder):
    return wl.climate_outliers(daily_table(spark, folder), limit=2.0, min_values=5)


MULTIDAY_CELLS = """
multiday AS (
  SELECT id, date, MAX(CASE WHEN element = 'PRCP' THEN tenths END) / 10.0 AS own,
         MAX(CASE WHEN element = 'SNOW' THEN tenths END) / 10.0 AS amount,
         MAX(CASE WHEN element = 'SNOW' THEN (tenths + 190) // 10 % 12 END) AS days
  FROM daily_cells WHERE element IN ('PRCP', 'SNOW') GROUP BY ALL
), covered AS (
  SELECT id, date AS ending, CAST(date - CAST(unnest(range(days)) AS INT) AS DATE) AS date
  FROM multiday WHERE amount IS NOT NULL AND days BETWEEN 2 AND 9
), judged AS (
  SELECT c.id, c.ending AS date, MIN(c.date) AS first_date,
         COUNT(*) FILTER (EXISTS (SELECT 1 FROM multiday o WHERE o.id = c.id AND o.date = c.date AND o.own IS NOT NULL)) AS n_observed,
         COUNT(*) FILTER ((SELECT COUNT(*) FROM covered o WHERE o.id = c.id AND o.date = c.date) > 1) AS n_shared
  FROM covered c GROUP BY ALL
)"""


def multiday_table(spark: SparkSession, folder: str) -> DataFrame:
    """Daily rows whose snow is taken as totals over up to eleven days."""
    path = encode.daily_text(spark, folder)
    readings = wl.scan_daily(spark, path, elements=("PRCP", "SNOW")).readings
    long = wl.to_daily_long(readings).select("id", "date", "element", "value")
    is_total = F.col("element") == "SNOW"
    totals = long.filter(is_total)
    lengths = F.floor((F.round(F.col("value").cast("double") * 10) + 190) / 10) % 12
    lengths = totals.withColumns({"element": F.lit("DAPR"), "value": lengths.cast("float")})
    return long.filter(~is_total).union(totals.withColumn("element", F.lit("MDPR"))).union(lengths)


@query(
    "x12_multiday_totals",
    f"""WITH {DAILY_CELLS}, {MULTIDAY_CELLS} SELECT id, 'MDPR' AS element, {text('date')} AS date,
        {number('amount')} AS value, {number('days')} AS days, {text('first_date')} AS first_date,
        {whole('n_observed')} AS n_observed, {whole('n_shared')} AS n_shared,
        n_observed IS NULL OR n_observed > 0 OR n_shared > 0 AS failed
        FROM multiday LEFT JOIN judged USING (id, date) WHERE amount IS NOT NULL""",
)
def x12(spark, folder):
    return wl.multiday_totals(multiday_table(spark, folder), most_days=9)


@query(
    "x12_spread_totals",
    f"""WITH {DAILY_CELLS}, {MULTIDAY_CELLS} SELECT id, 'PRCP' AS element, {text('c.date')} AS date,
        {number('CAST(CAST(CAST(amount AS FLOAT) AS DOUBLE) / days AS FLOAT)')} AS value
        FROM multiday m JOIN judged j USING (id, date) JOIN covered c ON c.id = m.id AND c.ending = m.date
        WHERE n_observed = 0 AND n_shared = 0""",
)
def x12_spread(spark, folder):
    return wl.spread_totals(wl.multiday_totals(multiday_table(spark, folder), most_days=9))


COARSE_DAYS = "(SELECT id, element, date, floor(CAST(value AS DOUBLE) / 10) * 10 AS value FROM daily)"


def coarse_days(spark: SparkSession, folder: str) -> DataFrame:
    """Values in steps of ten, so that equal ones follow each other."""
    coarse = (F.floor(F.col("value").cast("double") / 10) * 10).cast("float")
    return daily_table(spark, folder).withColumn("value", coarse)


@query(
    "x13_streaks",
    f"""WITH {DAILY_CELLS}, numbered AS (
          SELECT *, row_number() OVER (PARTITION BY id, element ORDER BY date)
                  - row_number() OVER (PARTITION BY id, element, value ORDER BY date) AS run
          FROM {COARSE_DAYS} WHERE value <> 0)
        SELECT id, element, {number('value')} AS value, {text('MIN(date)')} AS first_date,
        {text('MAX(date)')} AS last_date, {whole('COUNT(*)')} AS n_values
        FROM numbered GROUP BY id, element, value, run HAVING COUNT(*) >= 3""",
)
def x13(spark, folder):
    return wl.streaks(coarse_days(spark, folder), min_values=3, leave_out=0.0)


@query(
    "x13_frequent_values",
    f"""WITH {DAILY_CELLS}, counts AS (
          SELECT id, element, month(date) AS month, value, COUNT(*) AS n_values FROM {COARSE_DAYS} GROUP BY ALL),
        shares AS (SELECT *, SUM(n_values) OVER (PARTITION BY id, element, month) AS n_all FROM counts)
        SELECT id, element, {whole('month')} AS month, {number('value')} AS value,
        {whole('n_values')} AS n_values, {whole('n_all')} AS n_all FROM shares
        WHERE n_all >= 10 AND n_values >= 0.4 * n_all""",
)
def x13_frequent(spark, folder):
    return wl.frequent_values(coarse_days(spark, folder), share=0.4)


GAP_SQL = f"""WITH {DAILY_CELLS}, counts AS (
  SELECT id, element, month(date) AS month, value, COUNT(*) AS n FROM daily GROUP BY ALL
), ordered AS (
  SELECT *, SUM(n) OVER w AS so_far, SUM(n) OVER (PARTITION BY id, element, month) AS n_all,
         lag(value) OVER w AS before, lead(value) OVER w AS after
  FROM counts WINDOW w AS (PARTITION BY id, element, month ORDER BY value)
), middles AS (
  SELECT id, element, month, MIN(value) FILTER (2 * so_far >= n_all) AS middle FROM ordered GROUP BY ALL
), gaps AS (
  SELECT id, element, month,
         MAX(value) FILTER (value < middle AND round(after - value, 4) >= 10) AS low_end,
         MIN(value) FILTER (value > middle AND round(value - before, 4) >= 10) AS high_start
  FROM ordered JOIN middles USING (id, element, month) GROUP BY ALL
)"""


@query(
    "x14_gap_outliers",
    f"""{GAP_SQL} SELECT id, element, {text('date')} AS date, {number('value')} AS value,
        {number('low_end')} AS low_end, {number('high_start')} AS high_start
        FROM daily JOIN gaps USING (id, element)
        WHERE gaps.month = month(date) AND (value <= low_end OR value >= high_start)""",
)
def x14(spark, folder):
    return wl.gap_outliers(daily_table(spark, folder))


# --- X15 to X19: checks against the days, months and elements next to a value -


@query(
    "x15_copied_months",
    f"""WITH {MONTHLY_CELLS}, {MONTHLY_STATIONS}, cells AS (
          SELECT id, date, MAX(floor(CAST(value AS DOUBLE) / 10) * 10) AS own FROM monthly
          WHERE value IS NOT NULL GROUP BY ALL),
        {NEIGHBOUR_SQL.format(lookup='monthly_lookup', within=1000)}, pairs AS (
          SELECT a.id, a.date, a.own, b.own AS before FROM cells a JOIN cells b
          ON b.id = a.id AND b.date = a.date - INTERVAL 1 MONTH WHERE year(a.date) >= 1996)
        SELECT p.id, 'RAW' AS dataset, 'Max' AS element, {text('p.date')} AS date,
        {number('ANY_VALUE(p.own)')} AS value, {whole('COUNT(*)')} AS n_neighbours,
        {whole('COUNT(*) FILTER (abs(o.own - o.before) >= 5)')} AS n_changed
        FROM pairs p JOIN nearest USING (id) JOIN pairs o ON o.id = neighbour AND o.date = p.date
        WHERE p.own = p.before GROUP BY p.id, p.date
        HAVING COUNT(*) FILTER (abs(o.own - o.before) >= 5) >= 0.5 * COUNT(*)""",
)
def x15(spark, folder):
    """Values in steps of ten, so that some months equal the month before."""
    coarse = (F.floor(F.col("value").cast("double") / 10) * 10).cast("float")
    long = wl.to_monthly_long(monthly_readings(spark, folder))
    long = long.withColumns({"dataset": F.lit("RAW"), "element": F.lit("Max"), "value": coarse})
    return wl.copied_months(long, monthly_lookup(spark, folder), since=1996, change=5.0, within_km=1000.0)


WARM_NIGHTS = "(SELECT * FROM daily WHERE element = 'TMAX' OR element = 'TMIN' AND value > 0)"


@query(
    "x16_beyond_record",
    f"""WITH {DAILY_CELLS}, extremes AS (
          SELECT id, month(date) AS month, MAX(value) FILTER (element = 'TMAX') AS largest_high,
                 MIN(value) FILTER (element = 'TMIN') AS smallest_low FROM {WARM_NIGHTS} GROUP BY ALL),
        judged AS (
          SELECT d.id, element, date, value,
                 CASE WHEN element = 'TMAX' THEN smallest_low ELSE largest_high END AS bound
          FROM {WARM_NIGHTS} d JOIN extremes e ON e.id = d.id AND e.month = month(d.date))
        SELECT id, element, {text('date')} AS date, {number('value')} AS value, {number('bound')} AS bound
        FROM judged WHERE CASE WHEN element = 'TMAX' THEN value < bound ELSE value > bound END""",
)
def x16(spark, folder):
    """Without the cold nights, which leave no bound for the days."""
    daily = daily_table(spark, folder).filter("element = 'TMAX' or value > 0")
    return wl.beyond_record(daily)


@query(
    "x17_lagged_ranges",
    f"""WITH {DAILY_CELLS}, around AS (
          SELECT a.id, a.date, a.element, a.value, MAX(b.value) AS largest, MIN(b.value) AS smallest
          FROM daily a JOIN daily b ON b.id = a.id AND abs(b.date - a.date) <= 1
               AND b.element = CASE a.element WHEN 'TMAX' THEN 'TMIN' ELSE 'TMAX' END
          WHERE a.element IN ('TMAX', 'TMIN') GROUP BY ALL),
        bounds AS (SELECT *, CASE element WHEN 'TMAX' THEN largest ELSE smallest END AS bound FROM around)
        SELECT id, {text('date')} AS date, element, {number('value')} AS value, {number('bound')} AS bound
        FROM bounds WHERE round(CASE element WHEN 'TMAX' THEN value - bound ELSE bound - value END, 4) >= 30""",
)
def x17(spark, folder):
    return wl.lagged_ranges(daily_table(spark, folder), limit=30.0)


@query(
    "x18_spikes",
    f"""WITH {DAILY_CELLS} SELECT a.id, a.element, {text('a.date')} AS date, {number('a.value')} AS value,
        {number('b.value')} AS before, {number('c.value')} AS after
        FROM daily a JOIN daily b ON b.id = a.id AND b.element = a.element AND b.date = a.date - 1
                     JOIN daily c ON c.id = a.id AND c.element = a.element AND c.date = a.date + 1
        WHERE round(a.value - b.value, 4) >= 10 AND round(a.value - c.value, 4) >= 10
           OR round(a.value - b.value, 4) <= -10 AND round(a.value - c.value, 4) <= -10""",
)
def x18(spark, folder):
    return wl.spikes(daily_table(spark, folder), limit=10.0)


@query(
    "x19_mask_adjusted",
    f"""WITH {MONTHLY_CELLS}, flags AS (
          SELECT id, element, date FROM monthly WHERE dataset = 'RAW' AND flag = 5)
        SELECT m.id, {text('m.date')} AS date, dataset, m.element,
        {number("CASE WHEN dataset = 'FLS52' AND f.id IS NOT NULL THEN NULL ELSE value END")} AS value,
        CASE WHEN dataset = 'FLS52' AND f.id IS NOT NULL THEN 'M' WHEN flag = 5 THEN 'D' ELSE '' END AS qcflag
        FROM monthly m LEFT JOIN flags f ON f.id = m.id AND f.element = m.element AND f.date = m.date""",
)
def x19(spark, folder):
    long = wl.to_monthly_long(monthly_readings(spark, folder), flags=True)
    return wl.mask_adjusted(long).drop("lat", "lon", "dmflag", "dsflag")


ALL_DAYS = """(SELECT id, date, element, CAST(tenths / 10.0 AS FLOAT) AS value FROM daily_cells)"""


def all_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The days of every element, snow among them."""
    return wl.to_daily_long(wl.parse_daily(encode.daily_lines(spark, folder), None))


@query(
    "x20_uncorroborated",
    f"""{CLIMATE_SQL}, {DAILY_STATIONS}, {NEIGHBOUR_SQL.format(lookup='daily_lookup', within=1000)}, anomalies AS (
          SELECT d.id, d.element, d.date, d.value, round(CAST(d.value AS DOUBLE) - mean, 4) AS anomaly
          FROM days d JOIN climate c ON c.id = d.id AND c.element = d.element AND c.day = d.own
          WHERE n_values >= 5),
        judged AS (
          SELECT a.id, a.element, a.date, ANY_VALUE(a.value) AS value, ANY_VALUE(a.anomaly) AS anomaly,
                 COUNT(DISTINCT o.id) AS n_neighbours, MAX(o.anomaly * sign(a.anomaly)) AS best_anomaly
          FROM anomalies a JOIN nearest n ON n.id = a.id JOIN anomalies o
               ON o.id = n.neighbour AND o.element = a.element AND abs(o.date - a.date) <= 1
          WHERE abs(a.anomaly) >= 8 GROUP BY ALL)
        SELECT id, element, {text('date')} AS date, {number('value')} AS value, {number('anomaly')} AS anomaly,
        {whole('n_neighbours')} AS n_neighbours, {number('best_anomaly + 0.0')} AS best_anomaly
        FROM judged WHERE n_neighbours >= 2 AND round(abs(anomaly) - best_anomaly, 4) >= 8""",
)
def x20(spark, folder):
    stations = daily_lookup(spark, folder)
    return wl.uncorroborated(
        daily_table(spark, folder), stations, limit=8.0, witnesses=2, within_km=1000.0, min_values=5
    )


@query(
    "x21_snow_in_warmth",
    f"""WITH {DAILY_CELLS} SELECT s.id, {text('s.date')} AS date, {number('ANY_VALUE(s.value)')} AS value,
        {number('MIN(t.value)')} AS lowest
        FROM {ALL_DAYS} s JOIN {ALL_DAYS} t ON t.id = s.id AND abs(t.date - s.date) <= 1
        WHERE s.element = 'SNOW' AND t.element = 'TMIN' AND s.value > 0
        GROUP BY s.id, s.date HAVING MIN(t.value) >= 7""",
)
def x21(spark, folder):
    return wl.snow_in_warmth(all_daily(spark, folder))


@query(
    "x22_inconsistent_days",
    f"""WITH {DAILY_CELLS}, pairs AS (
          SELECT a.id, a.date, a.element, a.value, b.value AS other FROM {ALL_DAYS} a JOIN {ALL_DAYS} b
          ON b.id = a.id AND b.date = a.date AND (a.element, b.element) IN (('TMAX', 'TMIN'), ('SNOW', 'PRCP')))
        SELECT id, {text('date')} AS date, rule, {number('value')} AS value, {number('other')} AS other FROM (
          SELECT *, 'maximum_below_minimum' AS rule FROM pairs WHERE element = 'TMAX' AND value < other
          UNION ALL SELECT *, 'snow_without_precipitation' FROM pairs
          WHERE element = 'SNOW' AND value > 0 AND other = 0
          UNION ALL SELECT *, 'naught' FROM pairs
          WHERE element = 'TMAX' AND value = other AND round(CAST(value AS DOUBLE), 4) IN (0, -17))""",
)
def x22(spark, folder):
    """With a whole number as the second naught, as the values are."""
    return wl.inconsistent_days(all_daily(spark, folder), naughts=(0.0, -17.0))


@query(
    "x23_duplicate_months",
    f"""WITH {DAILY_CELLS}, months AS (
          SELECT id, element, date_trunc('month', date) AS month, COUNT(*) AS n_values,
                 string_agg(day(date) || ':' || value, ',' ORDER BY date) AS content
          FROM {COARSE_DAYS} GROUP BY ALL HAVING COUNT(*) >= 2 AND MIN(value) < MAX(value)),
        firsts AS (SELECT *, MIN(month) OVER (PARTITION BY id, element, content) AS first_month FROM months)
        SELECT id, element, {text('CAST(month AS DATE)')} AS month,
        {text('CAST(first_month AS DATE)')} AS first_month, {whole('n_values')} AS n_values
        FROM firsts WHERE month > first_month""",
)
def x23(spark, folder):
    return wl.duplicate_months(coarse_days(spark, folder), min_values=2)
