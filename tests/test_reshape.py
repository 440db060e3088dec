import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

import weatherloom as wl
from test_scans import daily_line

READING = (
    "id string, lat float, lon float, year int, month int, dataset string, element string, "
    "values array<float>"
)


def f32(x):
    return float(np.float32(x))


def test_long_rows_from_value_arrays(spark):
    tmax = [v + 10.0 for v in range(31)]
    rows = [
        ("USW00094728", 60.0, -150.0, 2019, 1, "UNKNOWN", "TMAX", tmax),
        ("USW00094728", 60.0, -150.0, 2019, 1, "UNKNOWN", "TMIN", [v - 5 for v in tmax]),
        ("USW00094728", 60.0, -150.0, 2019, 1, "UNKNOWN", "PRCP", [v * 0.1 for v in tmax]),
    ]
    long = wl.to_daily_long(spark.createDataFrame(rows, READING))
    assert long.columns == ["id", "date", "element", "dataset", "value", "lat", "lon"]
    assert dict(long.dtypes)["date"] == "date" and dict(long.dtypes)["value"] == "float"
    counts = {r.element: r.n_rows for r in wl.count_by(long, "element").collect()}
    assert counts == {"TMAX": 31, "TMIN": 31, "PRCP": 31}
    assert long.filter("value is null or lat != 60 or lon != -150").count() == 0
    last = long.filter("element = 'TMAX'").orderBy(F.desc("date")).first()
    assert (last.date, last.value) == (datetime.date(2019, 1, 31), 40.0)


def test_long_form_is_sparse(spark):
    values = [20.0 + day if day % 3 == 0 else None for day in range(31)]
    rows = [
        (f"USW000{i:05d}", None, None, 2024, 1, "UNKNOWN", "TMAX", values) for i in range(100)
    ]
    readings = spark.createDataFrame(rows, READING)
    assert wl.to_daily_long(readings).count() == 1100
    counts = wl.value_count(readings, wl.DAILY).first()
    assert (counts.n_values, counts.n_slots) == (1100, 3100)


def test_days_outside_the_month_are_dropped(spark, lines_of):
    rows = [
        ("a", 1.0, 1.0, 2019, 1, "UNKNOWN", "TMAX", [1.0] * 31),
        ("a", 1.0, 1.0, 2020, 2, "UNKNOWN", "TMAX", [1.0] * 31),
    ]
    assert wl.to_daily_long(spark.createDataFrame(rows, READING)).count() == 60
    lines = [
        daily_line([1] * 31, year=y, month=m)
        for y, m in (("2019", "02"), ("1900", "02"), ("2000", "02"), ("2019", "04"), ("2019", "13"), ("2019", "00"))
    ]
    long = wl.to_daily_long(wl.parse_daily(lines_of(lines)))
    counts = {r.m: r.n for r in long.groupBy(F.trunc("date", "MM").cast("string").alias("m")).agg(F.count("*").alias("n")).collect()}
    assert counts == {"2019-02-01": 28, "1900-02-01": 28, "2000-02-01": 29, "2019-04-01": 30}


def test_flags_travel_with_the_value(lines_of):
    line = daily_line([5] * 31, tail="B G")
    row = wl.to_daily_long(wl.parse_daily(lines_of([line])), flags=True).first()
    assert (row.mflag, row.qflag, row.sflag) == ("B", "", "G")
    assert wl.passed_quality(wl.to_daily_long(wl.parse_daily(lines_of([line])), flags=True)).count() == 31


def monthly_line(values, id="USH00000001", year=1990, flags="abc"):
    return f"{id} {year:04d}" + "".join(f"{v:>6}{flags}" for v in values)


def test_sparse_rows(lines_of):
    frames = [
        wl.parse_monthly(lines_of([monthly_line(range(100, 1300, 100))], name))
        for name in ("a.raw.tmax", "a.tob.tmin", "a.FLs.52j.tavg", "a.b.tmax", "a.raw.prcp")
    ]
    for frame, measure in zip(frames, ("max_raw", "min_tob", "avg_fls52", None, None)):
        rows = wl.to_monthly_sparse(frame).orderBy("date").collect()
        assert len(rows) == 12
        assert rows[0].date == datetime.date(1990, 1, 1) and rows[11].date == datetime.date(1990, 12, 1)
        for i, row in enumerate(rows):
            filled = {m: v for m, v in row.asDict().items() if "_" in m and v is not None}
            assert filled == ({measure: float(i + 1)} if measure else {})


def test_monthly_flags(lines_of):
    long = wl.to_monthly_long(wl.parse_monthly(lines_of([monthly_line([5] * 12)], "a.raw.tmax")), flags=True)
    row = long.first()
    assert (row.dmflag, row.qcflag, row.dsflag) == ("a", "b", "c")


def test_wide_rows(lines_of):
    sparse = [
        wl.to_monthly_sparse(wl.parse_monthly(lines_of([monthly_line(values)], name)))
        for name, values in {
            "a.raw.tmax": [100] * 12,
            "a.FLs.52j.tmax": [150] * 11 + [-9999],
            "a.raw.tmin": [300] * 12,
        }.items()
    ]
    union = sparse[0].unionByName(sparse[1]).unionByName(sparse[2])
    wide = wl.to_monthly_wide(union)
    assert wide.count() == 12
    first = wide.orderBy("date").first()
    assert (first.max_raw, first.max_fls52, first.min_raw, first.max_tob) == (1.0, 1.5, 3.0, None)
    pairs = wl.compare_quality(union)
    assert pairs.count() == 11
    assert {r.difference for r in pairs.collect()} == {0.5}
    assert wl.inconsistent_months(wide).count() == 12
    assert wl.average_from_extremes(wide).first().avg_raw_computed == 2.0


@pytest.mark.parametrize("count", [8_335, 25_001])
def test_every_reading_month_appears_once(spark, count):
    rows = spark.range(count).select(
        F.format_string("USH%08d", F.col("id")).alias("id"),
        F.lit(1990).alias("year"),
        F.lit("RAW").alias("dataset"),
        F.lit("Max").alias("element"),
        F.array(*[F.lit(float(m)).cast("float") for m in range(12)]).alias("values"),
    )
    sparse = wl.to_monthly_sparse(rows)
    stats = sparse.groupBy("id", "date").agg(F.count("*").alias("n"), F.first("max_raw").alias("v"), ).agg(
        F.count("*").alias("cells"), F.max("n").alias("most"),
        F.count_if(F.col("v") != F.month("date") - 1).alias("wrong"),
    ).first()
    assert (stats.cells, stats.most, stats.wrong) == (count * 12, 1, 0)


def test_lookup(spark):
    schema = (
        "country_code string, network_code string, id_placeholder string, coop_id string, "
        "latitude float, longitude float, position long"
    )
    rows = [
        ("US", "0", "00", "station0", 1.0, 2.0, 0),
        ("US", "0", "00", "station1", 9.0, 9.0, 1),
        ("US", "0", "00", "station1", 3.0, 4.0, 2),
        ("US", "0", "00", "station1", 5.0, None, 3),
        ("US", "0", "00", "station2", None, None, 4),
    ]
    lookup = wl.station_lookup(spark.createDataFrame(rows, schema))
    found = {r.id: (r.lat, r.lon) for r in lookup.collect()}
    assert found == {"US000station0": (1.0, 2.0), "US000station1": (3.0, 4.0)}


@pytest.mark.parametrize("budget", [64 * 1024 * 1024, 64])
def test_coordinate_join_keeps_every_reading(spark, budget):
    # station 0 holds a third of all readings; station 9 is not listed
    readings = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("s0"))
        .otherwise(F.concat(F.lit("s"), F.col("id") % 10))
        .alias("id"),
        F.col("id").alias("n"),
    )
    lookup = spark.createDataFrame(
        [(f"s{i}", float(i), -float(i)) for i in range(9)], "id string, lat float, lon float"
    )
    joined = wl.inject_coords(readings, lookup, budget)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (budget > 64)
    assert ("SortMergeJoin" in plan) == (budget == 64)
    assert joined.count() == 3000
    assert joined.agg(F.count_distinct("n")).first()[0] == 3000
    assert joined.filter("lat is null").select("id").distinct().collect()[0].id == "s9"
    assert joined.filter("lat != cast(substring(id, 2, 1) as float)").count() == 0


def test_copies_of_one_row_are_spread(spark):
    # one reading, copied: a third of all rows and more are the same
    copies = spark.range(0, 3200, 1, 16).select(F.lit("s0").alias("id"), F.lit(1).alias("n"))
    lookup = spark.createDataFrame([("s0", 1.0, 2.0), ("s1", 1.0, 2.0)], "id string, lat float, lon float")
    joined = wl.inject_coords(copies, lookup, budget=64)
    assert joined.count() == 3200 and joined.filter("lat = 1").count() == 3200
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_salt" in plan
    salts = copies.select(F.pmod(F.xxhash64("id", "n") + F.spark_partition_id(), F.lit(32)).alias("s"))
    assert salts.distinct().count() == 16


def test_exclude_files_without_broadcast(spark):
    readings = spark.range(100).select(F.format_string("f%d", F.col("id") % 4).alias("file_name"), "id")
    bad = spark.createDataFrame([("f1", 1), ("f2", 3)], "file_name string, bad_lines int")
    kept, listed = wl.exclude_files(readings, bad, budget=1)
    assert {r.file_name for r in kept.collect()} == {"f0", "f3"} and kept.count() == 50
    assert listed.count() == 2


def test_daily_scan_to_long_is_one_stage(spark, tmp_path):
    (tmp_path / "a.dly").write_text(daily_line([1] * 31) + "\n")
    lookup = spark.createDataFrame([("USC00011084", 1.0, 2.0)], "id string, lat float, lon float")
    scan = wl.scan_daily(spark, str(tmp_path))
    long = wl.to_daily_long(wl.inject_coords(scan.readings, lookup))
    assert long.count() == 31
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
