"""Scans and reshaping against plain Python on generated lines."""

import calendar
import datetime
import random
import re

import numpy as np

import weatherloom as wl


def parse_int(text):
    text = text.strip()
    return int(text) if re.fullmatch(r"[+-]?\d+", text) else None


def f32(number, scale):
    return float(np.float32(number) / np.float32(scale))


def brute_daily(lines):
    """The long rows of good lines and the number of bad ones."""
    rows, bad = [], 0
    for line in lines:
        data = line.removesuffix("\r")
        if len(data) < 21 or not re.fullmatch(r"[+\d]\d{3}[+\d]\d", data[11:17]):
            bad += 1
            continue
        element = data[17:21].upper()
        if element not in ("TMAX", "TMIN", "PRCP"):
            continue
        year, month = int(data[11:15]), int(data[15:17])
        for day in range(1, 32):
            start = 21 + (day - 1) * 8
            if start + 8 > len(data) or not 1 <= month <= 12:
                continue
            value = parse_int(data[start : start + 5])
            if value in (None, -9999) or day > calendar.monthrange(year, month)[1]:
                continue
            rows.append((data[:11], datetime.date(year, month, day), element, f32(value, 10)))
    return rows, bad


def brute_monthly(lines):
    rows = []
    for line in lines:
        data = line.removesuffix("\r")
        if len(data) < 123 or not re.fullmatch(r"[+\d]\d{3}", data[12:16]):
            continue
        for month in range(12):
            value = parse_int(data[16 + month * 9 : 22 + month * 9])
            value = None if value in (None, -9999) else f32(value, 100)
            rows.append((data[:11], datetime.date(int(data[12:16]), month + 1, 1), value))
    return rows


def random_slot(rng, width):
    kind = rng.random()
    if kind < 0.15:
        return "-9999"[:width].rjust(width)
    if kind < 0.2:
        return rng.choice(["", "+12", "1.5", "1 2", "x7", "-", "+", "12-", "0x1", "00012", "-0"]).rjust(width)
    return str(rng.randint(-999, 9999)).rjust(width)


def sorted_rows(rows):
    return sorted(rows, key=repr)


def test_daily_lines(lines_of):
    rng = random.Random(7)
    lines = []
    for _ in range(600):
        year = rng.choice(["1899", "1900", "1996", "2000", "2023", "19x4", "+194", " 194", "0001"])
        month = f"{rng.randint(0, 13):02d}" if rng.random() < 0.95 else rng.choice([" 1", "+1", "1 "])
        element = rng.choice(["TMAX", "tmin", "PrCp", "SNOW", "TOBS"])
        slots = "".join(random_slot(rng, 5) + rng.choice(["   ", "B G", "  6"]) for _ in range(31))
        line = f"USC{rng.randint(0, 99999999):08d}{year}{month}{element}{slots}"
        if rng.random() < 0.2:
            line = line[: rng.randint(0, len(line))]
        lines.append(line + ("\r" if rng.random() < 0.3 else ""))
    expected, bad = brute_daily(lines)
    df = lines_of(lines)
    long = wl.to_daily_long(wl.parse_daily(df))
    got = [tuple(r) for r in long.select("id", "date", "element", "value").collect()]
    assert sorted_rows(got) == sorted_rows(expected)
    assert wl.rejected_lines(df, wl.DAILY).count() == bad > 0
    # the array form gives the same rows
    arrays = wl.to_daily_long(wl.with_values(wl.parse_daily(df), wl.DAILY))
    same = [tuple(r) for r in arrays.select("id", "date", "element", "value").collect()]
    assert sorted_rows(same) == sorted_rows(expected)


def test_monthly_lines(lines_of):
    rng = random.Random(11)
    lines = []
    for _ in range(400):
        year = rng.choice(["1895", "2000", "19x4", "+194", "    "])
        slots = "".join(random_slot(rng, 6) + rng.choice(["   ", "abc", "E 1"]) for _ in range(12))
        line = f"USH{rng.randint(0, 99999999):08d} {year}{slots}"
        if rng.random() < 0.3:
            line = line[: rng.randint(100, len(line))]
        lines.append(line + ("\r" if rng.random() < 0.3 else ""))
    long = wl.to_monthly_long(wl.parse_monthly(lines_of(lines, "x.raw.tmax")))
    got = [tuple(r) for r in long.select("id", "date", "value").collect()]
    assert sorted_rows(got) == sorted_rows(brute_monthly(lines))


def test_isolated_values_and_duplicate_years(spark):
    rng = random.Random(3)
    rows = []
    for station in range(12):
        for year in range(1990, 2000):
            values = [
                float(rng.randint(1, 2)) if rng.random() < 0.06 else None for _ in range(12)
            ]
            rows.append((f"s{station}", year, "RAW", "Max", values))
    readings = spark.createDataFrame(
        rows, "id string, year int, dataset string, element string, values array<float>"
    )
    cells = {
        (id, year * 12 + month): value
        for id, year, _, _, values in rows
        for month, value in enumerate(values)
        if value is not None
    }
    isolated = {
        key
        for key in cells
        if not any(o != key and o[0] == key[0] and abs(o[1] - key[1]) <= 18 for o in cells)
    }
    got = {
        (r.id, r.date.year * 12 + r.date.month - 1)
        for r in wl.isolated_values(wl.to_monthly_long(readings)).collect()
    }
    assert got == isolated and isolated

    series = {}
    for id, year, _, _, values in rows:
        if any(v is not None for v in values):
            series.setdefault((id, tuple(values)), []).append(year)
    expected = {(id, len(y), min(y), max(y)) for (id, _), y in series.items() if len(y) > 1}
    found = {
        (r.id, r.n_years, r.first_year, r.last_year)
        for r in wl.duplicate_years(readings).collect()
    }
    assert found == expected and expected


def test_hot_station(spark):
    """One station holds most rows, and most of those are copies of one row."""
    rng = random.Random(5)
    hot = [("hot", 2000, "RAW", "Max", [float(m) for m in range(12)])] * 4000
    hot += [
        ("hot", rng.randint(1990, 1999), rng.choice(["RAW", "TOB"]), "Max",
         [rng.choice([None, 1.0, 2.0]) for _ in range(12)])
        for _ in range(500)
    ]
    rest = [
        (f"s{i % 50}", 2000, "FLS52", "Min", [float(i % 7)] * 12) for i in range(2000)
    ]
    rows = hot + rest
    readings = spark.createDataFrame(
        rows, "id string, year int, dataset string, element string, values array<float>"
    ).repartition(16)
    lookup = spark.createDataFrame([("hot", 1.0, 2.0), ("s1", 3.0, 4.0)], "id string, lat float, lon float")
    located = wl.inject_coords(readings, lookup, budget=64)
    assert located.count() == len(rows)
    assert located.filter("id = 'hot' and lat = 1").count() == len(hot)

    best = {}
    for id, year, dataset, element, values in rows:
        for month, value in enumerate(values, start=1):
            cell = best.setdefault((id, datetime.date(year, month, 1)), {})
            if value is not None:
                name = f"{element.lower()}_{dataset.lower()}"
                cell[name] = max(value, cell.get(name, value))
    wide = wl.to_monthly_wide(wl.to_monthly_sparse(located))
    got = {
        (r.id, r.date): {k: v for k, v in r.asDict().items() if "_" in k and v is not None}
        for r in wide.collect()
    }
    assert wide.count() == len(best) and got == best
