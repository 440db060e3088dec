"""Steps that must not grow wider than their input, with the results they had."""

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import weatherloom as wl
from weatherloom.functions import columns as C
from weatherloom.operators import corroboration
from weatherloom.plans import encode
from weatherloom.session import materialise

DAILY = "id string, date date, element string, value float"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lineitem(tmp_path):
    at = datetime.datetime
    rows = [
        # station, flag, status, shipped, quantity, line number
        (7, "A", "F", at(2001, 1, 1), 20.0, 1),
        (7, "A", "F", at(2001, 1, 1), 50.0, 6),
        (7, "A", "F", at(2001, 1, 31), 1.0, 2),
        (7, "N", "F", at(2001, 1, 31), None, 2),
        (7, "R", "O", at(2001, 2, 28), 30.0, 3),
        (7, "R", "F", None, 30.0, 3),
        (None, "A", "F", at(2001, 1, 2), 30.0, 3),
    ]
    names = ["l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity", "l_linenumber"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.timestamp("us"), pa.float64(), pa.int32()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)]
    pq.write_table(pa.table(columns, names), tmp_path / "lineitem.parquet")
    return str(tmp_path)


def test_daily_lines_are_built_from_narrow_rows(spark, lineitem):
    lines = encode.encode_daily(spark, lineitem)
    assert "s31" not in plan_of(lines)  # no row with a column for each slot
    none = "-9999   "
    header = "USC00000007"
    want = [
        (header + ".dly", header + "200101TMAX" + "  300 XC" + none * 29 + " -190  R"),
        (header + ".dly", header + "200101TMIN" + none * 31),
        (header + ".dly", header + "200102PRCP" + none * 27 + "  100  D" + none * 3),
        (header + ".dly", None),
        (None, None),
    ]
    got = [tuple(r) for r in lines.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_text_is_stored_compressed(spark, lineitem):
    path = encode.daily_text(spark, lineitem)
    names = [r.file_name for r in wl.list_files(spark, path).collect()]
    assert any(name.endswith(".gz") for name in names)
    assert spark.read.text(path).filter(F.length("value") == 269).count() == 3


@pytest.mark.parametrize("days", [0, 7, 200])
def test_climate_repeats_no_row_for_the_days_around(spark, days):
    dates = [(2001, 1, 1), (2002, 1, 1), (2001, 6, 15), (2001, 12, 31), (2004, 2, 29)]
    rows = [(None if i % 2 else "s", datetime.date(*d), "TMAX", float(i)) for i, d in enumerate(dates * 2)]
    frame = spark.createDataFrame(rows, DAILY)
    climate = wl.daily_climate(frame, days)
    assert f"[-{days}," not in plan_of(climate) and f"sequence(-{days}" not in plan_of(climate)
    best = {}
    for name, date, _, value in rows:
        best[name, date] = max(value, best.get((name, date), value))
    around = {}
    for (name, date), value in best.items():
        own = datetime.date(2000, date.month, date.day).timetuple().tm_yday
        for step in range(-days, days + 1):
            around.setdefault((name, (own + step - 1) % 366 + 1), []).append(value)
    got = {(r.id, r.day): (r.n_values, r.mean) for r in climate.collect()}
    assert got == {k: (len(v), pytest.approx(sum(v) / len(v))) for k, v in around.items()}


def test_anomalies_join_no_climate(spark):
    rows = [("s", datetime.date(2001, 3, d), "TMAX", float(d)) for d in range(1, 20)] + [(None, datetime.date(2001, 3, 1), "TMAX", 1.0)]
    found = wl.daily_anomalies(spark.createDataFrame(rows, DAILY), 1, 2)
    assert "Join" not in plan_of(found)
    got = {r.date.day: r.anomaly for r in found.collect()}
    assert got == {d: 0.0 for d in range(2, 19)} | {1: -0.5, 19: 0.5}


def test_chunks_are_cut_from_bytes_that_are_made_once(spark):
    lines = spark.createDataFrame([("ab" + "123456" + "78",), ("ab123\r",), ("ab",), ("",), (None,), ("abéé1",)], "line string")
    raw = lines.select("line", C.line_bytes(F.col("line")).alias("raw"))
    chunks = C.line_chunks(F.col("raw"), 2, 3, 2)
    got = [r.chunks for r in raw.select(chunks.alias("chunks")).collect()]
    assert got[:5] == [["123", "456"], ["123"], [], [], []]
    assert len(got[5]) == 2
    assert "filter(" not in plan_of(raw.select(chunks.alias("chunks")))


@pytest.mark.parametrize("days", [0, 1, 400])
def test_a_year_asks_a_neighbour_once(spark, days):
    dates = [datetime.date(2000, 12, 30) + datetime.timedelta(k) for k in range(4)] + [datetime.date(2002, 1, 1)]
    rows = [("a", "TMAX", d, float(k), 20.0 + k) for k, d in enumerate(dates)]
    rows += [(s, "TMAX", d, 0.0, 2.0 * k) for k, d in enumerate(dates[1:]) for s in "bc"] + [("b", "TMIN", dates[0], 0.0, 99.0)]
    anomalies = spark.createDataFrame(rows, "id string, element string, date date, value float, anomaly double")
    years = materialise(corroboration._years(anomalies, 10.0, days), "years")
    own = {(r.id, r.element, r.year): r.far_dates for r in years.collect() if r.far_dates}
    assert own == {("a", "TMAX", y): [d for d in dates if d.year == y] for y in (2000, 2001, 2002)} | {("b", "TMIN", 2000): dates[:1]}
    near = spark.createDataFrame([("a", ["b", "c", "none"]), ("b", ["a"])], "id string, near array<string>")
    found = corroboration._alone(years, near, 10.0, 2, days)
    assert "sequence(" not in plan_of(found) and "date_add" not in plan_of(found)  # no value is repeated for days
    want = {}
    for k, d in enumerate(dates):
        met = [2.0 * j for j, on in enumerate(dates[1:]) if abs((on - d).days) <= days]
        if met:
            want[d] = (float(k), 20.0 + k, 2, max(met))
    assert {r.date: (r.value, r.anomaly, r.n_neighbours, r.best_anomaly) for r in found.collect()} == want
    assert dict(found.dtypes)["n_neighbours"] == "int"
