"""Statistical checks against plain Python on generated series."""

import calendar
import datetime
import math
import random
import statistics

import numpy as np
import pytest

import weatherloom as wl
from weatherloom.operators import outliers

MONTHLY = "id string, date date, dataset string, element string, value float"
DAILY = "id string, date date, element string, value float"


def f32(x):
    return np.float32(x).item()


def biweight(values, reach=7.5, least=5):
    """(mean, deviation) by the formulas."""
    m = statistics.median(values)
    d = statistics.median(abs(x - m) for x in values)
    if d == 0 or len(values) < least:
        return None
    kept = [(x - m, ((x - m) / (reach * d)) ** 2) for x in values if abs(x - m) < reach * d]
    mean = m + sum(o * (1 - u) ** 2 for o, u in kept) / sum((1 - u) ** 2 for _, u in kept)
    top = math.sqrt(len(values) * sum(o * o * (1 - u) ** 4 for o, u in kept))
    return mean, top / abs(sum((1 - u) * (1 - 5 * u) for _, u in kept))


def monthly_rows(rng, stations=12, years=30):
    rows = []
    for s in range(stations):
        for year in range(1990, 1990 + years):
            for month in (1, 2, 7):
                if rng.random() < 0.9:
                    value = 10 * month + rng.gauss(0, 1.5) + (rng.choice([6, -7, 40]) if rng.random() < 0.04 else 0)
                    rows.append((f"s{s:02d}", datetime.date(year, month, 1), "RAW", "Max", f32(round(value, 2))))
    return rows


def plain_scores(rows, least=5):
    cells = {}
    for name, date, dataset, element, value in rows:
        if value is not None and date is not None:
            key = (name, dataset, element, date)
            cells[key] = max(value, cells.get(key, value))
    groups = {}
    for (name, dataset, element, date), value in cells.items():
        groups.setdefault((name, dataset, element, date.month), []).append(value)
    scores = {}
    for (name, dataset, element, date), value in cells.items():
        found = biweight(groups[name, dataset, element, date.month], least=least)
        scores[name, dataset, element, date] = (value - found[0]) / found[1] if found else None
    return scores


def test_biweight_scores(spark):
    rng = random.Random(1)
    rows = monthly_rows(rng)
    rows += [("flat", datetime.date(y, 1, 1), "RAW", "Max", 5.0) for y in range(1990, 2000)]
    rows += [("few", datetime.date(y, 1, 1), "RAW", "Max", float(y)) for y in range(1990, 1994)]
    rows += [(None, datetime.date(1990 + y, 1, 1), "RAW", "Max", float(y % 5)) for y in range(12)]
    rows += [("s00", datetime.date(1990, 1, 1), "RAW", "Max", None), ("s00", None, "RAW", "Max", 1.0)]
    rows += rows[:40]
    got = {
        (r.id, r.dataset, r.element, r.date): r.score
        for r in wl.biweight_scores(spark.createDataFrame(rows, MONTHLY)).collect()
    }
    want = plain_scores(rows)
    assert got.keys() == want.keys()
    for key, score in want.items():
        assert (got[key] is None) == (score is None) and (score is None or got[key] == pytest.approx(score))
    outliers_found = wl.biweight_outliers(spark.createDataFrame(rows, MONTHLY)).collect()
    assert {(r.id, r.dataset, r.element, r.date) for r in outliers_found} == {
        k for k, s in want.items() if s is not None and abs(s) >= 5
    }
    assert outliers_found


def ground(a, b):
    north1, east1, north2, east2 = (math.radians(x) for x in (*a, *b))
    h = math.sin((north1 - north2) / 2) ** 2 + math.cos(north1) * math.cos(north2) * math.sin((east1 - east2) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(h))


def plain_nearest(places, count, within):
    out = {}
    for name, here in places.items():
        near = sorted((round(ground(here, there), 6), other) for other, there in places.items() if other != name)
        out[name] = [(other, d) for d, other in near[:count] if d <= within]
    return out


@pytest.mark.parametrize("count,within", [(5, 500.0), (2, 60.0)])
def test_nearest_stations(spark, count, within):
    """Clusters, lone stations, one place of many, the poles and the date line."""
    rng = random.Random(4)
    places = {}
    for c in range(6):
        lat, lon = rng.uniform(20, 60), rng.uniform(-120, -70)
        for i in range(40):
            places[f"c{c}_{i:02d}"] = (f32(lat + rng.gauss(0, 0.3)), f32(lon + rng.gauss(0, 0.3)))
    places |= {f"w{i:03d}": (f32(rng.uniform(-90, 90)), f32(rng.uniform(-180, 180))) for i in range(120)}
    places |= {f"same{i:02d}": (10.0, 10.0) for i in range(15)}
    places |= {"east": (0.0, f32(179.9)), "west": (0.0, f32(-179.9)), "pole": (90.0, 0.0), "near": (f32(89.5), f32(170.0))}
    rows = [(name, *at) for name, at in places.items()] + [("nowhere", None, 1.0), ("half", 2.0, None), (None, 1.0, 1.0)]
    stations = spark.createDataFrame(rows, "id string, lat float, lon float")
    got = {}
    for r in wl.nearest_stations(stations, count, within).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.neighbour, r.distance_km))
        assert r.rank == len(got[r.id])
    want = plain_nearest(places, count, within)
    for name, near in want.items():
        found = got.pop(name, [])
        assert [round(d, 3) for _, d in found] == [round(d, 3) for _, d in near]
        if len({round(d, 3) for _, d in near}) == len(near):
            assert [o for o, _ in found] == [o for o, _ in near]
    assert not got and {o for o, _ in want["same14"]} <= {f"same{i:02d}" for i in range(5)}
    assert wl.nearest_stations(stations.limit(0)).count() == 0


def test_spatial_outliers(spark):
    rng = random.Random(9)
    rows = monthly_rows(rng, stations=30)
    places = {f"s{i:02d}": (f32(40 + (i // 6) * 1.1), f32(-100 + (i % 6) * 1.3)) for i in range(29)}
    lookup = spark.createDataFrame([(n, *at) for n, at in places.items()], "id string, lat float, lon float")
    scores = plain_scores(rows)
    near = plain_nearest(places, 5, 500.0)
    want = {}
    for (name, dataset, element, date), score in scores.items():
        if score is None or not 2.5 <= abs(score) < 5:
            continue
        others = [scores.get((o, dataset, element, date)) for o, _ in near.get(name, [])]
        others = [o * math.copysign(1, score) for o in others if o is not None]
        needed = next(b for a, b in reversed(outliers.WITNESS_SCORES) if abs(score) >= a)
        if others and max(others) < needed:
            want[name, date] = (len(others), max(others))
    got = {(r.id, r.date): (r.n_neighbours, r.best_score) for r in wl.spatial_outliers(spark.createDataFrame(rows, MONTHLY), lookup).collect()}
    assert got.keys() == want.keys() and want
    assert all(got[k][0] == n and got[k][1] == pytest.approx(best) for k, (n, best) in want.items())


def daily_rows(rng, stations=3, years=8):
    rows = []
    for s in range(stations):
        day = datetime.date(1999, 1, 1)
        while day.year < 1999 + years:
            if rng.random() < 0.5:
                value = round(15 - 10 * math.cos(day.timetuple().tm_yday / 58) + rng.gauss(0, 2), 1)
                value += 30 if rng.random() < 0.004 else 0
                rows.append((f"s{s}", day, "TMAX", f32(value)))
            day += datetime.timedelta(days=1)
    return rows


def year_day(date):
    return datetime.date(2000, date.month, date.day).timetuple().tm_yday


def test_climate_outliers(spark):
    rng = random.Random(2)
    rows = daily_rows(rng)
    rows += rows[:50] + [("s0", None, "TMAX", 1.0), ("s0", datetime.date(2000, 1, 1), "TMIN", None)]
    cells = {(n, d): v for n, d, e, v in rows if d is not None and v is not None}
    got = {(r.id, r.date): (r.n_values, r.mean, r.deviation, r.score)
           for r in wl.climate_outliers(spark.createDataFrame(rows, DAILY), min_values=40, limit=4.0).collect()}
    want = {}
    for (name, date), value in cells.items():
        own = year_day(date)
        window = [v for (n, d), v in cells.items() if n == name and min((own - year_day(d)) % 366, (year_day(d) - own) % 366) <= 7]
        if len(window) >= 40:
            mean, deviation = statistics.fmean(window), statistics.stdev(window)
            if abs(value - mean) / deviation >= 4:
                want[name, date] = (len(window), mean, deviation, (value - mean) / deviation)
    assert got.keys() == want.keys() and want
    for key, numbers in want.items():
        assert got[key] == pytest.approx(numbers, rel=1e-4, abs=1e-4)
    assert any(calendar.isleap(d.year) and (d.month, d.day) == (2, 29) for _, d in cells)


def test_gap_outliers(spark):
    rng = random.Random(3)
    rows = daily_rows(rng) + [("two", datetime.date(2001, 5, d), "TMIN", v) for d, v in enumerate([0.0, 12.0], start=1)]
    groups = {}
    for name, date, element, value in rows:
        groups.setdefault((name, element, date.month), []).append((value, date))
    want = set()
    for (name, _, _), cells in groups.items():
        values = sorted(v for v, _ in cells)
        middle = values[(len(values) + 1) // 2 - 1]
        high = next((b for a, b in zip(values, values[1:], strict=False) if b > middle and round(b - a, 4) >= 10), math.inf)
        low = next((a for a, b in reversed(list(zip(values, values[1:], strict=False))) if a < middle and round(b - a, 4) >= 10), -math.inf)
        want |= {(name, d) for v, d in cells if v >= high or v <= low}
    got = {(r.id, r.date) for r in wl.gap_outliers(spark.createDataFrame(rows + rows[:30], DAILY)).collect()}
    assert got == want and want


def test_empty_tables(spark):
    monthly, daily = spark.createDataFrame([], MONTHLY), spark.createDataFrame([], DAILY)
    stations = spark.createDataFrame([], "id string, lat float, lon float")
    assert wl.biweight_outliers(monthly).count() == wl.spatial_outliers(monthly, stations).count() == 0
    assert wl.climate_outliers(daily).count() == wl.gap_outliers(daily).count() == 0


def test_hot_station_is_bounded_by_its_calendar(spark):
    """Many copies of one value are one value in every later step."""
    rows = [("hot", datetime.date(1990 + y % 8, 1, 1), "RAW", "Max", float(y % 8)) for y in range(4000)]
    got = wl.biweight_scores(spark.createDataFrame(rows, MONTHLY)).collect()
    assert len(got) == 8 and {r.n_values for r in got} == {8}
