"""Time the headline queries on the tables of ``$BENCH_SF_DIR``.

Prints one JSON line. Each query runs twice and the faster run counts, so that
JVM warm-up and code generation are not measured. Encoding the tables as
fixed-width lines is preparation and reported on its own.
"""

import json
import os
import pathlib
import re
import sys
import tempfile
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

import weatherloom as wl  # noqa: E402
from weatherloom.plans import catalog, encode  # noqa: E402
from weatherloom.session import scratch_path  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")

# name in the result -> query of the catalogue
QUERIES = {
    "daily_scan_to_long": "e1_daily_long",
    "monthly_scan_to_sparse": "e2_monthly_sparse",
    "monthly_merge_to_wide": "e3_monthly_wide",
    "coordinate_join": "d1_inject_coords_daily",
    "compare_quality": "d3_compare_quality",
    "monthly_mean": "f4_monthly_mean",
    "bounding_box": "c6_bounding_box",
    "station_coordinates": "f6_station_coordinates",
    "integrity_report": "g_monthly_report",
    "profile": "f7_profile_monthly",
    "drop_bad_files": "c4_drop_file",
    "unpack_archives": "a6_unpack_archives",
    "best_source": "x7_best_source",
    "isolated_values": "x5_isolated_values",
    "duplicate_years": "x6_duplicate_years",
    "stream_daily": "j1_stream_daily",
}


def seconds(action, runs=2):
    best = None
    for _ in range(runs):
        start = time.perf_counter()
        action()
        spent = time.perf_counter() - start
        best = spent if best is None else min(best, spent)
    return round(best, 3)


def consume(df):
    """Compute every row and column without collecting them."""
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("weatherloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    daily_text = encode.daily_text(spark, FOLDER)
    for step in (100, 250000):
        encode.monthly_lines(spark, FOLDER, step)
    station_text = encode.station_text(spark, FOLDER, "daily")
    catalog.daily_lookup(spark, FOLDER)
    catalog.monthly_lookup(spark, FOLDER)
    encode.monthly_archives(spark, FOLDER)
    monthly_text = encode.monthly_folder(spark, FOLDER)
    prepared = round(time.perf_counter() - start, 3)

    timings = {}
    base = scratch_path(spark, "bench-output")

    def daily_run():
        lookup = wl.run_stations(spark, station_text, "daily_network", base, catalog.SNAPSHOT).lookup
        wl.run_daily(spark, daily_text, lookup, base, catalog.SNAPSHOT)

    timings["daily_text_to_parquet"] = seconds(daily_run)
    monthly_lookup = catalog.monthly_lookup(spark, FOLDER)
    timings["monthly_text_to_parquet"] = seconds(
        lambda: wl.run_monthly(spark, f"{monthly_text}/*", monthly_lookup, base, catalog.SNAPSHOT)
    )
    timings["monthly_mean_from_parquet"] = seconds(
        lambda: consume(wl.monthly_mean(wl.read_daily(spark, base, snapshot="latest"), "TMAX"))
    )
    for name, key in QUERIES.items():
        timings[name] = seconds(lambda: consume(catalog.BUILDERS[key](spark, FOLDER)))

    scale = re.search(r"sf([0-9.]+)$", FOLDER)
    print(
        json.dumps(
            {
                "metric": "sum of headline query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale.group(1)) if scale else None,
                "prepare_sec": prepared,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
