import datetime
import pathlib
import tarfile

import pyarrow.parquet as pq
import pytest

import weatherloom as wl
from test_reshape import monthly_line
from test_scans import daily_line, station_line


@pytest.fixture
def archive(tmp_path):
    """A small archive folder: daily, monthly, station list."""
    for folder in ("daily", "monthly", "lists"):
        (tmp_path / folder).mkdir()
    for s in range(3):
        lines = [
            daily_line([s * 10] * 31, id=f"USC0000000{s}", month=f"{m:02d}", element=e)
            for m in range(1, 13)
            for e in ("TMAX", "TMIN", "SNOW")
        ]
        (tmp_path / "daily" / f"USC0000000{s}.dly").write_text("\n".join(lines) + "\n")
        for suffix in ("raw.tmax", "tob.tmax", "FLs.52j.tmin"):
            text = monthly_line([100 * s] * 12, id=f"USH0000000{s}") + "\n"
            (tmp_path / "monthly" / f"USH0000000{s}.{suffix}").write_text(text)
    stations = [station_line(f"USC0000000{s}", f"{40 + s}.5", "-100.25") for s in range(2)]
    (tmp_path / "lists" / "stations.txt").write_text("\n".join(stations) + "\n")
    return tmp_path


def codecs(path):
    found = set()
    for file in pathlib.Path(path).rglob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        found.add(group.column(0).compression)
    return found


def test_daily_run(spark, archive):
    base = str(archive / "out")
    lookup = wl.run_stations(spark, str(archive / "lists"), "daily_network", base, "2025-06-27").lookup
    run = wl.run_daily(spark, str(archive / "daily"), lookup, base, "2025-06-27")
    assert run.readings == {"UNKNOWN": 72}
    assert run.rejects.count() == 0
    assert codecs(run.path) == {"ZSTD"}
    table = wl.read_daily(spark, base)
    assert table.columns[:7] == ["id", "date", "element", "dataset", "value", "lat", "lon"]
    assert table.count() == 3 * 2 * 366
    row = wl.coordinate_coverage(table).first()
    assert (row.n_rows, row.with_coordinates) == (2196, 1464)
    # writing the same day again replaces the snapshot
    wl.run_daily(spark, str(archive / "daily"), lookup, base, "2025-06-27")
    assert wl.read_daily(spark, base).count() == 2196
    stations = wl.read_stations(spark, base, "daily_network")
    assert stations.count() == 2 and stations.first().snapshot_date == datetime.date(2025, 6, 27)
    assert codecs(archive / "out" / "stations") == {"SNAPPY"}


def test_station_snapshots(spark, tmp_path):
    """Networks have dates of their own; only the chosen folders are read."""
    base = str(tmp_path / "out")
    line = "USC00437054  44.4200  -72.0194  213.4 VT SAINT JOHNSBURY                    HCN 72614"
    lines = spark.createDataFrame([(0, line)], "position int, line string").coalesce(1)
    stations = wl.parse_stations(lines, "daily_network")
    for network, date in (("daily_network", "2025-06-27"), ("daily_network", "2025-07-01"), ("monthly_network", "2025-06-27")):
        wl.write_stations(stations, base, network, date)

    def found(**chosen):
        rows = wl.read_stations(spark, base, **chosen)
        assert all("snapshot_date=" in name for name in rows.inputFiles())
        return sorted((r.network, str(r.snapshot_date)) for r in rows.collect()), len(rows.inputFiles())

    assert len(found()[0]) == 3 and len(found(network="daily_network")[0]) == 2
    assert found(snapshot="latest") == ([("daily_network", "2025-07-01"), ("monthly_network", "2025-06-27")], 2)
    assert found(snapshot="latest", network="daily_network") == ([("daily_network", "2025-07-01")], 1)
    assert found(snapshot="2025-06-27")[0] == [("daily_network", "2025-06-27"), ("monthly_network", "2025-06-27")]
    assert found(snapshot="2025-07-01") == ([("daily_network", "2025-07-01")], 1)
    for chosen in ({"snapshot": "2024-01-01"}, {"snapshot": "latest", "network": "none"}):
        with pytest.raises(ValueError):
            wl.read_stations(spark, base, **chosen)


def test_monthly_run(spark, archive):
    base = str(archive / "out")
    lookup = wl.run_stations(spark, str(archive / "lists"), "daily_network", base, "2025-06-27").lookup
    run = wl.run_monthly(spark, str(archive / "monthly"), lookup, base, "2025-06-27")
    assert run.readings == {"RAW": 3, "TOB": 3, "FLS52": 3, "UNKNOWN": 0}
    assert codecs(run.path) == {"SNAPPY"}
    datasets = sorted(p.name for p in pathlib.Path(run.path).iterdir() if p.is_dir())
    assert datasets == ["dataset=fls52", "dataset=raw", "dataset=tob"]
    raw = wl.read_monthly(spark, base, "RAW")
    assert raw.count() == 36 and raw.filter("max_raw is null").count() == 0
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan
    wl.run_monthly(spark, str(archive / "monthly"), lookup, base, "2025-06-27")
    assert wl.read_monthly(spark, base).count() == 108
    # a rerun without a dataset leaves nothing of it behind
    kept = wl.run_monthly(spark, str(archive / "monthly" / "*.raw.*"), lookup, base, "2025-06-27")
    assert sorted(p.name for p in pathlib.Path(kept.path).iterdir() if p.is_dir()) == ["dataset=raw"]


def test_unknown_names_are_read_and_station_lists_rejected(spark, tmp_path):
    folder = tmp_path / "monthly"
    folder.mkdir()
    for name in ("USH00000001.raw.tmax", "USH00000001", "unknown.file", "USH00000001.RAW.tmax"):
        (folder / name).write_text(monthly_line([1] * 12) + "\n")
    (folder / "stations.txt").write_text(station_line("USC00000001", "40.5", "-100.25") + "\n")
    lookup = spark.createDataFrame([], "id string, lat float, lon float")
    run = wl.run_monthly(spark, str(folder), lookup, str(tmp_path / "out"), "2025-06-27")
    assert run.readings == {"RAW": 1, "TOB": 0, "FLS52": 0, "UNKNOWN": 3}
    assert [r.file_name for r in run.rejects.collect()] == ["stations.txt"]


def test_snapshots_are_not_merged(spark, archive):
    base = str(archive / "out")
    lookup = spark.createDataFrame([], "id string, lat float, lon float")
    for date, pattern in (("2025-06-26", "*.raw.*"), ("2025-06-27", "*")):
        wl.run_monthly(spark, str(archive / "monthly" / pattern), lookup, base, date)
    both = wl.to_monthly_wide(wl.read_monthly(spark, base))
    assert {str(r.snapshot_date) for r in both.collect()} == {"2025-06-26", "2025-06-27"}
    newest = wl.read_monthly(spark, base, snapshot="latest")
    assert newest.count() == 108 and wl.snapshot_dates(spark, f"{base}/monthly")[-1] == "2025-06-27"
    assert "2025-06-26" not in "".join(newest.inputFiles())
    assert wl.read_monthly(spark, base, snapshot="2025-06-26").count() == 36


@pytest.mark.parametrize("bad_records", ["quarantine", "drop_file"])
def test_monthly_archive_run(spark, archive, bad_records):
    base = str(archive / "out")
    (archive / "monthly" / "broken.raw.tmin").write_text(
        monthly_line([1] * 12) + "\nUSH00000001 19x4\n"
    )
    (archive / "monthly" / "network-v2.5-stations.txt").write_text("USH00000001 no data\n")
    for suffix in ("raw", "tob", "52j", "stations"):
        with tarfile.open(archive / f"{suffix}.tar.gz", "w:gz") as tar:
            for file in sorted((archive / "monthly").iterdir()):
                if suffix in file.name:
                    tar.add(file, f"release.20250627/{file.name}")
    lookup = spark.createDataFrame([("USH00000000", 1.0, 2.0)], "id string, lat float, lon float")
    archives = spark.createDataFrame(
        [(str(path),) for path in archive.glob("*.tar.gz")], "archive string"
    )
    run = wl.run_monthly_archives(archives, lookup, base, "2025-06-27", bad_records)
    kept = 4 if bad_records == "quarantine" else 3
    assert run.readings == {"RAW": kept, "TOB": 3, "FLS52": 3, "UNKNOWN": 0}
    assert sorted(r.file_name for r in run.rejects.collect()) == [
        "broken.raw.tmin", "network-v2.5-stations.txt"
    ]
    assert wl.read_monthly(spark, base).count() == 12 * (kept + 6)
    spread = wl.unpack_archives(archives, spread=5)
    assert spread.rdd.getNumPartitions() == 5
    assert spread.count() == 9 + 2 + 1


def test_compact_monthly_output(spark, archive):
    base = str(archive / "out")
    sparse = wl.to_monthly_sparse(wl.scan_monthly(spark, str(archive / "monthly")).readings, True)
    path = wl.write_monthly(sparse.repartition(16), base, "2025-06-27", compact=True)
    assert wl.read_monthly(spark, base).count() == 108
    assert len(list(pathlib.Path(path).rglob("*.parquet"))) <= 9


def test_latest_snapshot(spark, archive):
    base = str(archive / "out")
    lookup = spark.createDataFrame([("USC00000000", 1.0, 2.0)], "id string, lat float, lon float")
    long = wl.to_daily_long(wl.inject_coords(wl.scan_daily(spark, str(archive / "daily")).readings, lookup))
    wl.write_daily(long.limit(10), base, "2025-06-26")
    wl.write_daily(long.limit(20), base, "2025-06-27")
    newest = wl.latest(wl.read_daily(spark, base))
    assert newest.count() == 20
    assert {str(r.snapshot_date) for r in newest.select("snapshot_date").distinct().collect()} == {"2025-06-27"}


def test_element_filter_reaches_the_scan(spark, archive):
    base = str(archive / "out")
    lookup = spark.createDataFrame([("USC00000000", 1.0, 2.0)], "id string, lat float, lon float")
    wl.run_daily(spark, str(archive / "daily"), lookup, base, "2025-06-27")
    means = wl.monthly_mean(wl.read_daily(spark, base), "TMAX")
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(element,TMAX)" in plan
    assert "ReadSchema: struct<date:date,element:string,value:float>" in plan
    boxed = wl.within_bbox(wl.read_daily(spark, base), 1, 2, 3, 4)
    plan = boxed._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat,1.0)" in plan


def test_stream_equals_batch(spark, archive):
    lookup = spark.createDataFrame([("USC00000000", 1.0, 2.0)], "id string, lat float, lon float")
    out, checkpoint = str(archive / "stream"), str(archive / "checkpoint")

    def run():
        lines = wl.landing_lines(spark, str(archive / "daily"), max_files_per_trigger=1)
        query = wl.append_daily(wl.stream_daily(lines, lookup), out, checkpoint)
        query.awaitTermination(120)
        return spark.read.parquet(out)

    def batch():
        scan = wl.scan_daily(spark, str(archive / "daily"))
        return wl.to_daily_long(wl.inject_coords(scan.readings, lookup))

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(run(), batch())
    # with rejects
    (archive / "daily" / "bad.dly").write_text("short\nUSC0000000119x401TMAX\n")
    rejects, state = str(archive / "rejects"), str(archive / "state")
    lines = wl.landing_lines(spark, str(archive / "daily"))
    wl.append_with_rejects(lines, lookup, f"{out}2", rejects, state).awaitTermination(120)
    assert same(spark.read.parquet(f"{out}2").drop("batch"), batch())
    assert sorted((r.file_name, r.reason) for r in spark.read.parquet(rejects).collect()) == [
        ("bad.dly", "bad year"), ("bad.dly", "short line")
    ]
    # a restart adds only the new file
    (archive / "daily" / "late.dly").write_text(daily_line([3] * 31, id="USC00000009") + "\n")
    assert same(run(), batch())
