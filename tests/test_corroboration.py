"""Checks against stations nearby, other elements and other months, by plain Python."""

import datetime
import random
import statistics

import pytest

import weatherloom as wl

from test_consistency import ONE, cells_of, frame
from test_outliers import f32, plain_nearest, year_day


def station_days(seed, stations=8, days=900):
    """Stations that share their weather, with values that only one of them has."""
    rng = random.Random(seed)
    weather = [rng.gauss(0, 4) for _ in range(days)]
    rows = []
    for s in range(stations):
        for k in range(days):
            date = datetime.date(1999, 12, 1) + k * ONE
            for element in ("TMAX", "TMIN"):
                if rng.random() < 0.8:
                    lone = rng.choice([-15, 15]) if rng.random() < 0.02 else 0
                    rows.append((f"s{s}", date, element, f32(round(10 + weather[k] + rng.gauss(0, 1) + lone, 1))))
    rows += rows[:100] + [(*r[:3], f32(r[3] - 50)) for r in rows[100:110]]
    return [*rows, ("s0", None, "TMAX", 1.0), ("s0", datetime.date(2000, 1, 1), "TMAX", None), (None, datetime.date(2000, 1, 1), "TMAX", 90.0)]


PLACES = {f"s{i}": (f32(40 + i * 0.3), f32(-100 + (i % 3) * 0.2)) for i in range(8)} | {"silent": (40.05, -100.0)}


def plain_anomalies(cells, least):
    groups = {}
    for (name, element, date), value in cells.items():
        groups.setdefault((name, element), {}).setdefault(year_day(date), []).append(value)
    out = {}
    for (name, element, date), value in cells.items():
        own, by_day = year_day(date), groups[name, element]
        window = [v for step in range(-7, 8) for v in by_day.get((own + step - 1) % 366 + 1, [])]
        if len(window) >= least and name is not None:
            out[name, element, date] = value - statistics.fmean(window)
    return out


@pytest.mark.parametrize("days,witnesses", [(1, 3), (0, 2)])
def test_uncorroborated(spark, days, witnesses):
    rows = station_days(1)
    cells = cells_of(rows)
    anomalies = plain_anomalies(cells, 20)
    near, want = plain_nearest(PLACES, 4, 150.0), {}
    for (name, element, date), own in anomalies.items():
        if round(abs(own), 4) < 8:
            continue
        sign = 1 if own > 0 else -1
        met = {
            o: [anomalies[o, element, date + k * ONE] * sign for k in range(-days, days + 1) if (o, element, date + k * ONE) in anomalies]
            for o, _ in near[name]
        }
        met = {o: found for o, found in met.items() if found}
        if len(met) >= witnesses and abs(own) - max(max(found) for found in met.values()) >= 8:
            want[name, element, date] = (own, len(met), max(max(found) for found in met.values()))
    stations = spark.createDataFrame([(n, *at) for n, at in PLACES.items()], "id string, lat float, lon float")
    found = wl.uncorroborated(
        frame(spark, rows), stations, limit=8.0, witnesses=witnesses, days=days, count=4, within_km=150.0, min_values=20
    ).collect()
    got = {(r.id, r.element, r.date): (r.anomaly, r.n_neighbours, r.best_anomaly) for r in found}
    assert len(got) == len(found) and got.keys() == want.keys() and len(want) > 20
    for key, numbers in want.items():
        assert got[key] == pytest.approx(numbers, abs=1e-3)
    assert all(r.value == cells[r.id, r.element, r.date] for r in found)


@pytest.mark.parametrize("days", [0, 1, 2])
def test_snow_in_warmth(spark, days):
    rng = random.Random(2)
    rows = []
    for k in range(1200):
        date = datetime.date(1999, 11, 1) + k * ONE
        rows += [(s, date, e, f32(round(rng.gauss(m, 4), 1))) for s in ("a", None) for e, m in (("SNOW", 0), ("TMIN", 9)) if rng.random() < 0.5]
    rows += rows[:50] + [(*r[:3], f32(r[3] - 3)) for r in rows[50:60]] + [("a", None, "SNOW", 1.0), ("a", datetime.date(2000, 1, 1), "SNOW", None)]
    cells, want = cells_of(rows), set()
    for (name, element, date), value in cells.items():
        around = [cells.get((name, "TMIN", date + k * ONE)) for k in range(-days, days + 1)]
        around = [v for v in around if v is not None]
        if element == "SNOW" and value > 0 and around and round(min(around), 4) >= 7:
            want.add((name, date, value, min(around)))
    got = [tuple(r) for r in wl.snow_in_warmth(frame(spark, rows), days=days).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_inconsistent_days(spark):
    rng = random.Random(3)
    rows = []
    for k in range(1500):
        date = datetime.date(2000, 1, 1) + k * ONE
        for element, choices in (("TMAX", [0, -17.8, 5, 9.1]), ("TMIN", [0, -17.8, 5, 7]), ("SNOW", [0, 3]), ("PRCP", [0, 0.3]), ("TOBS", [0])):
            if rng.random() < 0.8:
                rows.append((rng.choice(["a", None]), date, element, f32(rng.choice(choices))))
    rows += rows[:50] + [("a", None, "TMAX", 1.0), ("a", datetime.date(2000, 1, 1), "TMIN", None)]
    cells, want = cells_of(rows), set()
    for name, date in {(n, d) for n, _, d in cells}:
        high, low, snow, rain = (cells.get((name, e, date)) for e in ("TMAX", "TMIN", "SNOW", "PRCP"))
        if high is not None and low is not None:
            if high < low:
                want.add((name, date, "maximum_below_minimum", high, low))
            if high == low and round(high, 4) in (0, -17.8):
                want.add((name, date, "naught", high, low))
        if snow is not None and rain is not None and snow > 0 and rain == 0:
            want.add((name, date, "snow_without_precipitation", snow, rain))
    got = [tuple(r) for r in wl.inconsistent_days(frame(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert len({rule for _, _, rule, *_ in want}) == 3


def test_duplicate_months(spark):
    rng = random.Random(4)
    rows = []
    for name in ("a", "b", None):
        for k in range(36):
            first = datetime.date(2000 + k // 12, k % 12 + 1, 1)
            pattern = random.Random(k % 5 if k % 2 else k).choices([1.5, 2.0, 7.0], k=28)
            days = [d for d in range(28) if name != "b" or rng.random() < 0.97]
            rows += [(name, first + d * ONE, "TMAX", f32(pattern[d])) for d in days]
            rows += [(name, first + d * ONE, "PRCP", 0.0) for d in days]
            rows += [(name, first + d * ONE, "SNOW", float(d % 2)) for d in range(rng.choice([2, 3]))]
    # one day more is another month
    rows += [("a", datetime.date(2001, 1, 30), "TMAX", 1.0)]
    rows += rows[:60] + [(*r[:3], f32(r[3] - 3)) for r in rows[60:70]] + [("a", None, "TMAX", 1.0)]
    months = {}
    for (name, element, date), value in cells_of(rows).items():
        months.setdefault((name, element, date.replace(day=1)), []).append((date.day, value))
    seen, want = {}, set()
    for (name, element, month), days in sorted(months.items(), key=lambda m: m[0][2]):
        if len(days) >= 10 and len({v for _, v in days}) > 1:
            first = seen.setdefault((name, element, tuple(sorted(days))), month)
            if first != month:
                want.add((name, element, month, first, len(days)))
    got = [tuple(r) for r in wl.duplicate_months(frame(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {n for n, *_ in want} >= {"a", None} and {e for _, e, *_ in want} == {"TMAX"}


def test_empty_tables(spark):
    daily = frame(spark, station_days(5, 1, 1)).limit(0)
    stations = spark.createDataFrame([], "id string, lat float, lon float")
    assert wl.uncorroborated(daily, stations).count() == 0
    for check in (wl.snow_in_warmth, wl.inconsistent_days, wl.duplicate_months, wl.daily_anomalies):
        assert check(daily).count() == 0
