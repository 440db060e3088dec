import datetime

from pyspark.sql import functions as F

import weatherloom as wl
from test_reshape import monthly_line

DAILY = "id string, date date, element string, dataset string, value float, lat float, lon float"


def daily(spark, rows):
    return spark.createDataFrame(
        [(i, datetime.date.fromisoformat(d), e, "UNKNOWN", v, lat, lon) for i, d, e, v, lat, lon in rows],
        DAILY,
    )


def test_monthly_mean_fills_empty_months(spark):
    df = daily(
        spark,
        [
            ("a", "2019-01-31", "TMAX", 1.0, 1.0, 1.0),
            ("b", "2019-01-01", "TMAX", 2.0, 1.0, 1.0),
            ("a", "2019-04-30", "TMAX", 5.0, 1.0, 1.0),
            ("a", "2019-06-30", "TMIN", 9.0, 1.0, 1.0),
        ],
    )
    means = {str(r.month): r.mean_value for r in wl.monthly_mean(df, "TMAX").collect()}
    assert means == {
        "2019-01-31": 1.5, "2019-02-28": None, "2019-03-31": None, "2019-04-30": 5.0
    }
    assert wl.monthly_mean(df, "PRCP").count() == 0


def test_box_borders_are_inclusive(spark):
    rows = [("a", "2019-01-01", "TMAX", 1.0, lat, lon) for lat in (30.1, 45.0, 45.01) for lon in (-100.0, -80.7, -79.0)]
    box = wl.within_bbox(daily(spark, rows), 30.1, 45.0, -100.0, -80.7)
    assert box.count() == 4


def test_coverage_coordinates_and_points(spark):
    df = daily(
        spark,
        [("a", "2019-01-01", "TMAX", 1.0, 1.0, 2.0)] * 3 + [("b", "2019-01-01", "TMAX", 1.0, None, None)],
    )
    row = wl.coordinate_coverage(df).first()
    assert (row.n_rows, row.with_coordinates, row.percent) == (4, 3, 75.0)
    assert wl.coordinate_coverage(df.limit(0)).first().percent is None
    assert wl.station_coordinates(df).count() == 2
    points = {r.id: r.geometry for r in wl.station_points(df).collect()}
    assert (points["a"].lon, points["a"].lat) == (2.0, 1.0)


def test_complete_rows(spark):
    df = daily(spark, [("a", "2019-01-01", "TMAX", 1.0, 1.0, 2.0), ("b", "2019-01-01", "TMAX", 1.0, None, 1.0)])
    assert [r.id for r in wl.complete_rows(df, ["id", "lat", "lon"]).collect()] == ["a"]
    assert wl.complete_rows(df, ["id", "lon"]).count() == 2


def test_integrity(spark):
    df = daily(
        spark,
        [
            ("a", "2019-01-01", "TMAX", 61.0, 40.0, -100.0),
            ("b", "2019-01-01", "PRCP", 300.0, 17.0, -100.0),
            ("c", "2019-01-01", "TMIN", -50.0, None, -10.0),
        ],
    )
    report = {r.rule: (r.checked, r.violations) for r in wl.check_integrity(df, wl.daily_rules()).collect()}
    assert report["temperature in [-50, 60]"] == (2, 1)
    assert report["lat is present"] == (3, 1)
    assert report["lat in [18, 71]"] == (2, 1)
    assert report["lon in [-178, -65]"] == (3, 1)
    assert report["value is present"] == (3, 0)


def test_monthly_integrity(spark, lines_of):
    sparse = wl.to_monthly_sparse(wl.parse_monthly(lines_of([monthly_line([9000] + [100] * 11)], "a.raw.tmax")))
    shifted = sparse.withColumn("date", F.date_add("date", 3))
    report = {r.rule: (r.checked, r.violations) for r in wl.check_integrity(shifted, wl.monthly_rules()).collect()}
    assert report["max_raw in [-50, 60]"] == (12, 1)
    assert report["min_raw in [-50, 60]"] == (0, 0)
    assert report["date is the first of a month"] == (12, 12)
    assert report["lat is present"] == (12, 12)


def test_profile(lines_of):
    lines = lines_of(
        [monthly_line([1] * 12, year=1990), monthly_line([1] * 12, "USH00000002", 1880), "USH00000003 19x4", "short"],
        "a.raw.tmax",
    )
    row = wl.profile_monthly(lines).first()
    assert (row.n_stations, row.n_years, row.first_year, row.last_year) == (3, 2, 1880, 1990)
    assert wl.profile_monthly(lines, first_lines=1).first().last_year == 1990
    stats = wl.file_statistics(lines).first()
    assert (stats.n_lines, stats.first_line_length) == (4, 16 + 108)
    assert [r.line[12:16] for r in wl.sample_lines(lines, 2).collect()] == ["1990", "1880"]
    chunks = wl.explain_layout(wl.sample_lines(lines, 1)).collect()
    assert [(c.slot, c.chunk) for c in chunks] == [(i + 1, "     1abc") for i in range(12)]


def test_examine_sample(spark, tmp_path):
    folder = tmp_path / "release.20250627"
    folder.mkdir()
    for name in ("B.raw.tmax", "A.raw.tmax", "0.raw.tmin"):
        (folder / name).write_text(monthly_line([1] * 12) + "\n")
    assert wl.first_matching_file(spark, str(tmp_path)).endswith("/A.raw.tmax")
    found = wl.examine_sample(spark, str(tmp_path))
    assert found["statistics"].first().file_name == "A.raw.tmax"
    assert found["layout"].count() == 12 and found["sample"].count() == 1
    assert wl.examine_sample(spark, str(tmp_path), suffix="none") == {}


def test_first_lines_read_the_first_files_only(spark, tmp_path):
    """One file as a rule, more where they hold too few lines; unread ones may be broken."""
    for name, years in {"A.raw.tmax": [1990, 1880], "sub/B.raw.tmax": [1700], "C.raw.tmin": range(1900, 1950)}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join(monthly_line([1] * 12, year=y) + "\n" for y in years))
    (tmp_path / "empty").mkdir()

    def found(count, **options):
        lines = wl.first_lines(spark, str(tmp_path), count, **options)
        files = {name.rsplit("/", 1)[-1] for name in lines.inputFiles()}
        return [(r.file_name, int(r.line[12:16])) for r in lines.collect()], files

    assert found(2) == ([("A.raw.tmax", 1990), ("A.raw.tmax", 1880)], {"A.raw.tmax"})
    rows, files = found(3)
    assert rows == [("A.raw.tmax", 1990), ("A.raw.tmax", 1880), ("B.raw.tmax", 1700)]
    assert len(found(1000)[0]) == 53 and found(5, pattern="*.tmin")[1] == {"C.raw.tmin"}
    assert found(5, pattern="*.none")[0] == []

    lines = wl.lines_of_first_file(spark, str(tmp_path), "tmin")
    assert lines.count() == 50 and [f.rsplit("/", 1)[-1] for f in lines.inputFiles()] == ["C.raw.tmin"]
    assert wl.lines_of_first_file(spark, str(tmp_path), "none") is None


LONG = "id string, date date, element string, dataset string, value float, qflag string, sflag string"


def test_isolated_values(spark):
    def row(id, date, value=1.0):
        return (id, datetime.date.fromisoformat(date), "Max", "RAW", value, "", "")

    rows = [
        row("alone", "1990-01-01"),
        row("near", "1990-01-01"), row("near", "1991-07-01"),  # 18 months apart
        row("far", "1990-01-01"), row("far", "1991-08-01"),  # 19 months apart
        row("gap", "1990-01-01"), row("gap", "1991-01-01", None), row("gap", "1992-01-01"),
        row("twice", "1990-01-01"), row("twice", "1990-01-01"),
    ]
    df = spark.createDataFrame(rows, LONG)
    counts = {r.id: r.n_rows for r in wl.count_by(wl.isolated_values(df), "id").collect()}
    assert counts == {"alone": 1, "far": 2, "gap": 2, "twice": 1}


def test_duplicate_years(lines_of):
    lines = [
        monthly_line([1, 2] + [-9999] * 10, year=1990),
        monthly_line([1, 2] + [-9999] * 10, year=1995),
        monthly_line([1, 3] + [-9999] * 10, year=1996),
        monthly_line([-9999] * 12, year=1997),
        monthly_line([-9999] * 12, year=1998),
        monthly_line([1, 2] + [-9999] * 10, "USH00000002", 1990),
    ]
    (row,) = wl.duplicate_years(wl.parse_monthly(lines_of(lines, "a.raw.tmax"))).collect()
    assert (row.id, row.n_years, row.first_year, row.last_year) == ("USH00000001", 2, 1990, 1995)


def test_best_source(spark):
    date = datetime.date(2020, 1, 1)
    rows = [
        ("a", date, "TMAX", "UNKNOWN", 1.0, "", "S"),
        ("a", date, "TMAX", "UNKNOWN", 2.0, "", "Z"),
        ("a", date, "TMIN", "UNKNOWN", 3.0, "", "?"),
        ("a", date, "TMIN", "UNKNOWN", 4.0, "", "S"),
        ("b", date, "TMIN", "UNKNOWN", 4.0, "", "6"),
        ("b", date, "TMIN", "UNKNOWN", 5.0, "", "6"),
        ("c", date, "TMIN", "UNKNOWN", 6.0, "", ""),
        ("c", date, "TMIN", "UNKNOWN", 7.0, "", "S"),
    ]
    frame = spark.createDataFrame(rows, LONG)
    best = wl.best_source(frame)
    assert best.columns == frame.columns and {r.dataset for r in best.collect()} == {"UNKNOWN"}
    assert {(r.id, r.element, r.value, r.sflag) for r in best.collect()} == {
        ("a", "TMAX", 2.0, "Z"),
        ("a", "TMIN", 4.0, "S"),
        ("b", "TMIN", 5.0, "6"),
        ("c", "TMIN", 7.0, "S"),
    }
