"""Checks against neighbouring days, months and elements, by plain Python."""

import datetime
import random

import numpy as np
import pytest

import weatherloom as wl

from test_outliers import MONTHLY, plain_nearest

DAILY = "id string, date date, element string, value float"
ONE = datetime.timedelta(days=1)


def f32(x):
    return np.float32(x).item()


def daily_rows(seed, stations=3, days=800):
    rng = random.Random(seed)
    rows = []
    for s in range(stations):
        for k in range(days):
            for element, middle in (("TMAX", 20), ("TMIN", 5), ("PRCP", 3)):
                if rng.random() < 0.6:
                    value = f32(round(middle + rng.gauss(0, 9), 1))
                    rows.append((f"s{s}", datetime.date(1999, 12, 1) + k * ONE, element, value))
    rows += rows[:100]  # repeated rows
    rows += [(*r[:3], f32(r[3] - 50)) for r in rows[100:110]]  # the larger value counts
    return [*rows, ("s0", None, "TMAX", 1.0), ("s0", datetime.date(2000, 1, 1), "TMAX", None), (None, datetime.date(2000, 1, 1), "TMAX", 90.0)]


def cells_of(rows):
    cells = {}
    for name, date, element, value in rows:
        if date is not None and value is not None:
            key = (name, element, date)
            cells[key] = max(value, cells.get(key, value))
    return cells


def frame(spark, rows):
    return spark.createDataFrame(rows, DAILY).repartition(5)


def test_spikes(spark):
    rows = daily_rows(1)
    cells = cells_of(rows)
    want = set()
    for (name, element, date), value in cells.items():
        a, b = cells.get((name, element, date - ONE)), cells.get((name, element, date + ONE))
        if a is not None and b is not None:
            up, down = round(value - a, 4), round(value - b, 4)
            if min(up, down) >= 15 or max(up, down) <= -15:
                want.add((name, element, date, value, a, b))
    got = {tuple(r) for r in wl.spikes(frame(spark, rows), 15.0).collect()}
    assert got == want and any((d.month, d.day) in ((12, 31), (1, 1)) or d.day in (1, 28, 30, 31) for _, _, d, *_ in want)
    assert wl.spikes(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("days", [0, 1, 3])
def test_lagged_ranges(spark, days):
    rows = daily_rows(2)
    cells = cells_of(rows)
    want = set()
    for (name, element, date), value in cells.items():
        if element == "PRCP":
            continue
        other = "TMIN" if element == "TMAX" else "TMAX"
        around = [cells.get((name, other, date + k * ONE)) for k in range(-days, days + 1)]
        around = [v for v in around if v is not None]
        if around:
            bound = max(around) if element == "TMAX" else min(around)
            if round((value - bound) if element == "TMAX" else (bound - value), 4) >= 12:
                want.add((name, date, element, value, bound))
    got = {tuple(r) for r in wl.lagged_ranges(frame(spark, rows), limit=12.0, days=days).collect()}
    assert got == want and want


def test_beyond_record(spark):
    rows = [r for r in daily_rows(3) if r[2] != "TMIN" or r[3] is None or r[3] > 14]
    cells = [(n, e, d, v) for n, d, e, v in rows if d is not None and v is not None]
    want = []
    for name, element, date, value in cells:
        other = "TMIN" if element == "TMAX" else "TMAX"
        record = [v for n, e, d, v in cells if n == name and e == other and d.month == date.month]
        if element != "PRCP" and record and name is not None:
            bound = min(record) if element == "TMAX" else max(record)
            if value < bound if element == "TMAX" else value > bound:
                want.append((name, element, date, value, bound))
    got = [tuple(r) for r in wl.beyond_record(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(want) and want


def test_copied_months(spark):
    rng = random.Random(5)
    places = {f"s{i}": (f32(40 + i * 0.7), f32(-100 + (i % 3))) for i in range(9)}
    rows = []
    for name in [*places, "lost"]:
        for k in range(60):
            year, month = divmod(1998 * 12 + k, 12)
            if rng.random() < 0.9:
                rows.append((name, datetime.date(year, month + 1, 1), "RAW", "Max", f32(rng.choice([1, 1.5, 3, 3.2]))))
    rows += rows[:30] + [("s0", None, "RAW", "Max", 1.0), ("s0", datetime.date(2001, 1, 1), "TOB", "Max", None)]
    cells = {(n, d): v for n, d, _, _, v in rows if d is not None and v is not None}
    back = lambda d: (d - ONE).replace(day=1)
    near, want = plain_nearest(places, 3, 200.0), set()
    for (name, date), value in cells.items():
        if date.year < 2000 or cells.get((name, back(date))) != value:
            continue
        others = [cells[o, date] - cells[o, back(date)] for o, _ in near.get(name, []) if (o, date) in cells and (o, back(date)) in cells]
        changed = sum(round(abs(c), 4) >= 1 for c in others)
        if others and changed >= 0.5 * len(others):
            want.add((name, "RAW", "Max", date, value, len(others), changed))
    lookup = spark.createDataFrame([(n, *at) for n, at in places.items()], "id string, lat float, lon float")
    found = wl.copied_months(spark.createDataFrame(rows, MONTHLY), lookup, count=3, within_km=200.0)
    assert {tuple(r) for r in found.collect()} == want and want
    assert any(r[3].month == 1 for r in want)
    assert wl.copied_months(spark.createDataFrame(rows, MONTHLY).limit(0), lookup).count() == 0


@pytest.mark.parametrize("budget", [1 << 26, 0])
def test_mask_adjusted(spark, budget):
    day = datetime.date(2001, 1, 1)
    rows = [
        ("a", day, "RAW", "Max", 1.0, "D", "x"), ("a", day, "FLS52", "Max", 2.0, "", "y"), ("a", day, "FLS52", "Max", 2.0, "", "y"),
        ("a", day, "FLS52", "Min", 3.0, "", "z"), ("b", day, "RAW", "Max", 1.0, "", "x"), ("b", day, "FLS52", "Max", 4.0, "A", "x"),
        ("c", day, "RAW", "Max", 1.0, None, "x"), ("c", day, "FLS52", "Max", 5.0, None, "x"), ("d", day, "RAW", "Max", None, "I", "x"),
        ("d", day, "FLS52", "Max", None, "", "x"), ("e", None, "RAW", "Max", 1.0, "D", "x"), ("e", None, "FLS52", "Max", 6.0, "", "x"),
    ]
    table = spark.createDataFrame(rows, "id string, date date, dataset string, element string, value float, qcflag string, other string")
    got = wl.mask_adjusted(table, budget=budget)
    assert got.columns == table.columns
    lost = {("a", "Max"), ("d", "Max")}
    want = [(*r[:4], None, "M", r[6]) if r[2] == "FLS52" and (r[0], r[3]) in lost else r for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
