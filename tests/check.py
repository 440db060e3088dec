"""Compare every registered query with its SQL, value by value.

    python tests/check.py [folder] [name ...]
"""

import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def expected_rows(folder, sql):
    con = duckdb.connect()
    for file in sorted(pathlib.Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    return names, cursor.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(df, folder, sql):
    """Number of rows, and a message when the results differ."""
    got = normal(df.columns, [tuple(row) for row in df.collect()])
    want = normal(*expected_rows(folder, sql))
    if got[0] != want[0]:
        return len(got[1]), f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]))[:3]
        missing = sorted(set(want[1]) - set(got[1]))[:3]
        return len(got[1]), f"{len(got[1])} rows, expected {len(want[1])}\n  got {extra}\n  expected {missing}"
    return len(got[1]), None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as spark_entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or sorted(spark_entry.oracle_sql())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            rows, message = differences(
                spark_entry.queries()[name](session, folder), folder, spark_entry.oracle_sql()[name]
            )
        except Exception as error:  # report and go on
            rows, message = -1, f"{type(error).__name__}: {str(error)[:600]}"
        failed += message is not None
        print(f"{'FAIL' if message else 'ok  '} {name:34} {rows:8} rows {time.time() - start:6.2f} s", flush=True)
        if message:
            print("  " + message, flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} equal")
