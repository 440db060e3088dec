import pytest
from pyspark.sql import functions as F

import weatherloom as wl

DAILY_LINE = (
    "USC00011084192601TOBS"
    + "-9999   " * 20
    + "  217  6   28  6   39  6   44  6  100  6  106  6  117  6  106  6  128  6   94  6  189  6"
)
MONTHLY_LINE = (
    "USH0048961511894   517a     377a    1096d    1640b    2231     2485a   -9999     2938"
    "    -9999    -9999    -9999    -9999    -9999   "
)
MONTHLY_SHORT_LINE = (
    "USH0045726711892 -9999      532    -9999    -9999 Q   1869b    2209     2481     2734"
    "     2233     1711      777  3   -50  3"
)
STATION_LINES = [
    "USH00011084  31.0581  -87.0547   25.9 AL BREWTON 3 SSE                  ------ ------ ------ +6",
    "USC00437054  44.4200  -72.0194  213.4 VT SAINT JOHNSBURY                    HCN 72614",
]


def daily_line(values, id="USC00011084", year="2020", month="01", element="TMAX", tail="  6"):
    slots = "".join(f"{v:>5}{tail}" for v in values)
    return f"{id}{year}{month}{element}{slots}"


def as_f32(x):
    import numpy as np

    return float(np.float32(x))


def values_of(df):
    return [list(row[0]) for row in df.select("values").collect()]


def test_daily_line(lines_of):
    assert len(DAILY_LINE.rstrip()) == 269 or len(DAILY_LINE) == 269
    readings = wl.with_values(wl.parse_daily(lines_of([DAILY_LINE]), None), wl.DAILY)
    row = readings.first()
    assert (row.id, row.year, row.month) == ("USC00011084", 1926, 1)
    assert (row.element, row.dataset) == ("TOBS", "UNKNOWN")
    assert len(row["values"]) == 31
    assert row["values"][0] is None
    assert row["values"][30] == as_f32(18.9)
    # not a core element
    assert wl.parse_daily(lines_of([DAILY_LINE])).count() == 0


def test_daily_value_grammar(lines_of):
    texts = ["   12", "  +12", "  -12", " 1.5 ", " 1 2 ", "     ", "-9999", " 21+7", "99999"]
    line = daily_line(texts + ["-9999"] * 22)
    (values,) = values_of(wl.with_values(wl.parse_daily(lines_of([line])), wl.DAILY))
    assert values[:9] == [
        as_f32(1.2), as_f32(1.2), as_f32(-1.2), None, None, None, None, None, as_f32(9999.9)
    ]


@pytest.mark.parametrize("ending", ["", "\r"])
def test_daily_slot_beyond_the_line_is_missing(lines_of, ending):
    full = daily_line([10] * 31)
    cut_inside_last = full[:-1]
    cut_after_five = full[: 21 + 5 * 8]
    lines = [full + ending, cut_inside_last + ending, cut_after_five + ending]
    counts = [
        sum(v is not None for v in values)
        for values in values_of(wl.with_values(wl.parse_daily(lines_of(lines)), wl.DAILY))
    ]
    assert counts == [31, 30, 5]


def test_daily_element_is_case_insensitive(lines_of):
    lines = [daily_line([1] * 31, element=e) for e in ("tmax", "Tmin", "PRCP", "SNOW")]
    readings = wl.parse_daily(lines_of(lines))
    assert [r.element for r in readings.collect()] == ["TMAX", "TMIN", "PRCP"]
    custom = wl.parse_daily(lines_of(lines), ("SNOW",))
    assert [r.element for r in custom.collect()] == ["SNOW"]


def test_daily_rejects(lines_of):
    good = daily_line([1] * 31)
    lines = [
        good,
        "",
        "USC0001108419",
        daily_line([1] * 31, year="19x4"),
        daily_line([1] * 31, year=" 194"),
        daily_line([1] * 31, year="-194"),
        daily_line([1] * 31, year="+194"),
        daily_line([1] * 31, month=" 1"),
        daily_line([1] * 31, month="13"),
    ]
    df = lines_of(lines)
    # month 13 is a record, just not a date
    assert sorted((r.year, r.month) for r in wl.parse_daily(df).collect()) == [
        (194, 1),
        (2020, 1),
        (2020, 13),
    ]
    reasons = [r.reason for r in wl.rejected_lines(df, wl.DAILY).collect()]
    assert reasons == ["short line", "short line", "bad year", "bad year", "bad year", "bad month"]


def test_byte_positions_hold_for_multibyte_text(lines_of):
    line = daily_line([7] * 31, id="USé1234567")  # eleven bytes, ten characters
    row = wl.parse_daily(lines_of([line])).first()
    assert (row.id, row.year, row.element) == ("USé1234567", 2020, "TMAX")


def test_monthly_lines(lines_of):
    df = lines_of([MONTHLY_LINE, MONTHLY_SHORT_LINE], "USH00297610.raw.tmax")
    first, second = wl.with_values(wl.parse_monthly(df), wl.MONTHLY).collect()
    assert (first.id, first.year, first.dataset, first.element) == (
        "USH00489615", 1894, "RAW", "Max"
    )
    assert first["values"][0] == as_f32(5.17)
    assert first["values"][7] == as_f32(29.38)
    assert first["values"][11] is None
    assert (second.id, second.year) == ("USH00457267", 1892)
    assert second["values"][0] is None
    assert second["values"][7] == as_f32(27.34)
    assert second["values"][11] == as_f32(-0.5)


def test_monthly_length_guard(lines_of):
    df = lines_of(
        [MONTHLY_SHORT_LINE[:122], MONTHLY_SHORT_LINE[:123], MONTHLY_SHORT_LINE[:122] + "\r"],
        "x.raw.tmax",
    )
    assert wl.parse_monthly(df).count() == 1
    assert wl.rejected_lines(df, wl.MONTHLY).count() == 2


def test_monthly_value_is_six_wide(lines_of):
    line = "USH00457267 1892" + "-12345   " + "123456abc" + "-9999    " * 10
    (values,) = values_of(wl.with_values(wl.parse_monthly(lines_of([line], "x.tob.tavg")), wl.MONTHLY))
    assert values[:3] == [as_f32(-123.45), as_f32(1234.56), None]


@pytest.mark.parametrize(
    "name, dataset, element",
    [
        ("USH00297610.tob.tmax", "TOB", "Max"),
        ("USH00297610.raw.tavg", "RAW", "Avg"),
        ("USH00118916.FLs.52j.tmin", "FLS52", "Min"),
        ("USH00118916.any.thing.tmin", "FLS52", "Min"),
        ("USH00118916.RAW.tmax", "UNKNOWN", "Max"),
        ("USH00118916.raw.TMAX", "RAW", "Unknown"),
        ("unknown.file", "UNKNOWN", "Unknown"),
        ("a.b.c.d.tmax", "UNKNOWN", "Unknown"),
        ("network-v2.5-stations.txt", "UNKNOWN", "Unknown"),
    ],
)
def test_file_properties(lines_of, name, dataset, element):
    row = wl.parse_monthly(lines_of([MONTHLY_LINE], name)).first()
    assert (row.dataset, row.element) == (dataset, element)


def test_station_lines(lines_of):
    df = lines_of(STATION_LINES)
    h = wl.parse_stations(df, "monthly_network").first()
    assert (h.country_code, h.network_code, h.id_placeholder, h.coop_id) == ("US", "H", "00", "011084")
    assert (h.latitude, h.longitude, h.elevation) == tuple(map(as_f32, (31.0581, -87.0547, 25.9)))
    assert (h.state, h.name) == ("AL", "BREWTON 3 SSE")
    c = wl.parse_stations(df, "daily_network").collect()[1]
    assert (c.country_code, c.network_code, c.id_placeholder, c.coop_id) == ("US", "C", "00", "437054")
    assert (c.latitude, c.longitude, c.elevation) == tuple(map(as_f32, (44.42, -72.0194, 213.4)))
    assert (c.state, c.name) == ("VT", "SAINT JOHNSBURY")
    ids = [r.id for r in wl.station_lookup(wl.parse_stations(df, "daily_network")).collect()]
    assert sorted(ids) == ["USC00437054", "USH00011084"]


def station_line(id, lat, lon, elevation="  25.9", state="AL", name="SOMEWHERE"):
    return f"{id:11} {lat:>8} {lon:>9} {elevation:>6} {state:2} {name:30} "


def test_station_numbers(lines_of):
    lines = [
        station_line("USC00000001", "44.4200", "-999.9", "-999.9", "  "),
        station_line("USC00000002", "1d", "nan", "1234.5"),
        station_line("USC00000003", "", "1e1", "x"),
        "USC00000004 too short",
    ]
    df = lines_of(lines)
    a, b, c = wl.parse_stations(df, "daily_network").collect()
    assert (a.latitude, a.longitude, a.elevation, a.state) == (as_f32(44.42), None, None, None)
    assert b.latitude is None and b.longitude != b.longitude
    assert b.elevation == as_f32(1234.5)
    assert (c.latitude, c.longitude, c.elevation) == (None, 10.0, None)
    assert wl.rejected_stations(df, "daily_network").count() == 1


def test_scan_directory(spark, tmp_path):
    for i in range(3):
        text = "\n".join(daily_line([i] * 31, id=f"USC0000000{i}") for _ in range(2))
        (tmp_path / f"USC0000000{i}.dly").write_text(text + ("\r\n" if i else "\n"))
    scan = wl.scan_daily(spark, str(tmp_path))
    assert scan.readings.count() == 6
    assert scan.rejects.count() == 0
    names = {r.file_name for r in wl.parse_daily(wl.read_lines(spark, str(tmp_path))).select("file_name").distinct().collect()}
    assert names == {f"USC0000000{i}.dly" for i in range(3)}


def test_bad_record_modes(spark, tmp_path):
    good = daily_line([1] * 31)
    (tmp_path / "a.dly").write_text(f"{good}\n{good}\n")
    (tmp_path / "b.dly").write_text(f"{good}\nbroken\n{good}\n")
    quarantine = wl.scan_daily(spark, str(tmp_path))
    assert quarantine.readings.count() == 4
    assert [(r.file_name, r.line) for r in quarantine.rejects.collect()] == [("b.dly", "broken")]
    drop = wl.scan_daily(spark, str(tmp_path), bad_records="drop_file")
    assert {r.file_name for r in drop.readings.collect()} == {"a.dly"}
    assert drop.readings.count() == 2
    assert [(r.file_name, r.bad_lines) for r in drop.rejects.collect()] == [("b.dly", 1)]
    with pytest.raises(ValueError):
        wl.scan_daily(spark, str(tmp_path), bad_records="ignore")


def test_monthly_folder_with_station_list(spark, tmp_path):
    for name in ("X.raw.tmax", "X.tob.tmin", "X.FLs.52j.tavg"):
        (tmp_path / name).write_text(MONTHLY_LINE + "\n")
    (tmp_path / "network-v2.5-stations.txt").write_text(STATION_LINES[0] + "\n")
    scan = wl.scan_monthly(spark, str(tmp_path))
    assert sorted((r.dataset, r.element) for r in scan.readings.collect()) == [
        ("FLS52", "Avg"),
        ("RAW", "Max"),
        ("TOB", "Min"),
    ]
    assert [r.file_name for r in scan.rejects.collect()] == ["network-v2.5-stations.txt"]
    left = [r.file_name for r in wl.unread_files(spark, str(tmp_path)).collect()]
    assert left == ["network-v2.5-stations.txt"]


def test_line_position_orders_a_split_file(spark, tmp_path):
    path = tmp_path / "numbers.txt"
    path.write_text("".join(f"{i:07d}\n" for i in range(20_000)))
    (tmp_path / "letters.txt").write_text("a\n" + "bcd\n" * 9_999)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = wl.read_lines(spark, str(path), with_position=True)
        assert lines.rdd.getNumPartitions() > 4
        ordered = [r.line for r in lines.orderBy("position").collect()]
        stats = wl.file_statistics(wl.read_lines(spark, str(tmp_path), with_position=True))
        assert "SortAggregate" not in stats._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in stats.collect()} == {
            ("numbers.txt", 20_000, 7), ("letters.txt", 10_000, 1)
        }
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ordered == [f"{i:07d}" for i in range(20_000)]


def test_every_tenth_and_hundredth_is_the_nearest_float(spark):
    import numpy as np

    df = spark.range(-99_999, 100_000).select(
        "id",
        (F.col("id").cast("int") / F.lit(10.0)).cast("float").alias("tenth"),
        (F.col("id").cast("int") / F.lit(100.0)).cast("float").alias("hundredth"),
    )
    pdf = df.toPandas()
    ints = pdf["id"].to_numpy().astype(np.float32)
    assert (pdf["tenth"].to_numpy() == ints / np.float32(10)).all()
    assert (pdf["hundredth"].to_numpy() == ints / np.float32(100)).all()


def test_archives(spark, tmp_path):
    import io
    import tarfile

    for a in range(2):
        with tarfile.open(tmp_path / f"net.{a}.tar.gz", "w:gz") as tar:
            for m in range(3):
                data = "".join(f"{MONTHLY_LINE}\n" for _ in range(m + 1)).encode("utf-8")
                info = tarfile.TarInfo(f"release.20250627/USH{a}{m}.raw.tmax")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    paths = [(str(tmp_path / f"net.{a}.tar.gz"),) for a in range(2)]
    lines = wl.unpack_archives(spark.createDataFrame(paths, "archive string"), block_bytes=300)
    assert lines.count() == 12
    assert lines.select("archive", "file_name").distinct().count() == 6
    assert sorted(r.row for r in lines.select("position.row").collect()) == [1] * 6 + [2] * 4 + [3] * 2
    parsed = wl.parse_monthly(lines)
    assert parsed.count() == 12
    assert {r.dataset for r in parsed.collect()} == {"RAW"}


def tar_bytes(names, text=MONTHLY_LINE + "\n"):
    import io
    import tarfile

    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name in names:
            info = tarfile.TarInfo(f"release/{name}")
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))
    return out.getvalue()


def unpacked(spark, path, **more):
    return wl.unpack_archives(spark.createDataFrame([(str(path),)], "archive string"), **more)


def test_archive_of_several_gzip_members(spark, tmp_path):
    import gzip

    plain = tar_bytes(["A.raw.tmax", "B.raw.tmax", "C.raw.tmax"])
    (tmp_path / "two.tar.gz").write_bytes(gzip.compress(plain[:700]) + gzip.compress(plain[700:]))
    assert unpacked(spark, tmp_path / "two.tar.gz").count() == 3
    joined = gzip.compress(tar_bytes(["A.raw.tmax"])) + gzip.compress(tar_bytes(["B.raw.tmax"]))
    (tmp_path / "joined.tar.gz").write_bytes(joined)
    assert {r.file_name for r in unpacked(spark, tmp_path / "joined.tar.gz").collect()} == {"A.raw.tmax", "B.raw.tmax"}


@pytest.mark.parametrize("cut", [1024, 1024 + 100, 600, 0, -600])
def test_cut_archives_are_errors(spark, tmp_path, cut):
    import gzip

    plain = tar_bytes(["A.raw.tmax", "B.raw.tmax"])
    end = 4 * 512  # two members, each a header and a block; the end mark follows
    path = tmp_path / "cut.tar.gz"
    path.write_bytes(gzip.compress(plain[: end + cut if cut < 0 else cut]) if cut < end else b"")
    with pytest.raises(Exception, match="cut.tar.gz cannot be read to its end"):
        unpacked(spark, path).count()
    path.write_bytes(gzip.compress(plain)[:-20])
    with pytest.raises(Exception, match="cut.tar.gz cannot be read to its end"):
        unpacked(spark, path).count()


def test_archive_lines_keep_their_bytes_and_numbers(spark, tmp_path):
    import gzip

    text = "é1\r\n\n" + "x" * 5000 + "\nlast"
    (tmp_path / "t.tar.gz").write_bytes(gzip.compress(tar_bytes(["A.raw.tmax"], text)))
    for size in (3, 100, 1 << 20):
        rows = unpacked(spark, tmp_path / "t.tar.gz", block_bytes=size, spread=4).collect()
        assert [r.line for r in sorted(rows, key=lambda r: r.position.row)] == ["é1\r", "", "x" * 5000, "last"]
        assert sorted(r.position.row for r in rows) == [1, 2, 3, 4]
    plan = unpacked(spark, tmp_path / "t.tar.gz", spread=4)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan


def test_archive_paths(spark, tmp_path, monkeypatch):
    import gzip
    import os

    (tmp_path / "t.tar.gz").write_bytes(gzip.compress(tar_bytes(["A.raw.tmax"])))
    relative = os.path.relpath(tmp_path / "t.tar.gz")
    for path in (relative, f"file:{tmp_path}/t.tar.gz", f"file://{tmp_path}/t.tar.gz", str(tmp_path / "t.tar.gz")):
        assert unpacked(spark, path).count() == 1


def test_archives_can_be_profiled(spark, tmp_path):
    import gzip

    (tmp_path / "t.tar.gz").write_bytes(gzip.compress(tar_bytes(["B.raw.tmax", "A.raw.tmax", "0.raw.tmin"])))
    archives = spark.createDataFrame([(str(tmp_path / "t.tar.gz"),)], "archive string")
    found = wl.examine_archives(archives)
    assert [tuple(r) for r in found["statistics"].collect()] == [("A.raw.tmax", 1, len(MONTHLY_LINE))]
    assert found["sample"].count() == 1 and found["profile"].first().n_stations == 1


def test_last_list_wins_whatever_its_size(spark, tmp_path):
    def line(lat):
        return STATION_LINES[0][:12] + f"{lat:8.4f}" + STATION_LINES[0][20:]

    for small, large in (("a", "b"), ("b", "a")):
        lists = []
        for name, lat in (("a", 11.0), ("b", 22.0)):
            path = tmp_path / f"{small}{name}.txt"
            more = 3000 if name == large else 0
            filler = [line(1.0).replace("USH00011084", f"USH{i:08d}") for i in range(90_000_00, 90_000_00 + more)]
            path.write_text("\n".join([line(lat), *filler]) + "\n")
            lists.append(str(path))
        lookup = wl.station_lookup(wl.scan_stations(spark, lists, "monthly_network"))
        assert lookup.filter("id = 'USH00011084'").first().lat == 22.0
        lookup = wl.station_lookup(wl.scan_stations(spark, lists[::-1], "monthly_network"))
        assert lookup.filter("id = 'USH00011084'").first().lat == 11.0


def test_short_names_of_stations(spark, tmp_path):
    (tmp_path / "list.txt").write_text(STATION_LINES[0][:44] + "\n" + STATION_LINES[0][:30] + "\n")
    run = wl.run_stations(spark, str(tmp_path / "list.txt"), "monthly_network", str(tmp_path / "out"), "2025-06-27")
    assert run.lookup.count() == 1
    assert wl.read_stations(spark, str(tmp_path / "out")).first().name == STATION_LINES[0][41:44].strip()
    assert run.rejects.count() == 1


def test_carriage_return_is_no_flag(lines_of):
    full = monthly = MONTHLY_LINE[:123]
    for line in (full, monthly + "\r"):
        long = wl.to_monthly_long(wl.parse_monthly(lines_of([line], "X.raw.tmax")), flags=True)
        assert long.orderBy("date").collect()[-1].dsflag == ""
        assert "\r" not in "".join(r.chunk for r in wl.explain_layout(lines_of([line])).collect())


def test_archive_manifest(spark):
    names = [r.archive for r in wl.archive_manifest(spark, "hcn", "store/v2").collect()]
    assert len(names) == len(set(names)) == 9
    assert "store/v2/hcn.tmin.latest.raw.tar.gz" in names
    assert "store/v2/hcn.tavg.latest.FLs.52j.tar.gz" in names
