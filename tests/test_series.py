"""Multiday totals, streaks and frequent values against plain Python."""

import datetime
import random
from collections import Counter

import numpy as np

import weatherloom as wl

SCHEMA = "id string, date date, element string, value float"
ONE = datetime.timedelta(days=1)


def f32(x):
    return np.float32(x).item()


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain_totals(rows, most=31):
    """{(id, end): (amount, days, observed, shared, failed)} of MDPR with DAPR and PRCP."""
    cells = {}
    for name, date, element, value in rows:
        if date is not None and value is not None:
            key = (name, date, element)
            cells[key] = max(value, cells.get(key, value))
    spans = {}
    for (name, date, element), amount in cells.items():
        if element == "MDPR":
            days = cells.get((name, date, "DAPR"))
            whole = days is not None and days == int(days) and 2 <= days <= most
            spans[name, date] = (amount, days, [date - k * ONE for k in range(int(days))] if whole else None)
    covered = Counter((name, d) for (name, _), (_, _, span) in spans.items() for d in span or ())
    out = {}
    for (name, date), (amount, days, span) in spans.items():
        observed = shared = None
        if span:
            observed = sum((name, d, "PRCP") in cells for d in span)
            shared = sum(covered[name, d] > 1 for d in span)
        out[name, date] = (amount, days, observed, shared, not span or observed > 0 or shared > 0)
    return out


def test_multiday_totals(spark):
    rng = random.Random(6)
    rows = []
    for s in range(4):
        for k in range(900):
            day = datetime.date(2000, 1, 1) + k * ONE
            if rng.random() < 0.1:
                rows.append((f"s{s}", day, "PRCP", f32(rng.randint(0, 300) / 10)))
            if rng.random() < 0.08:
                rows.append((f"s{s}", day, "MDPR", f32(rng.randint(1, 600) / 10)))
                if rng.random() < 0.9:
                    rows.append((f"s{s}", day, "DAPR", f32(rng.choice([0, 1, 2, 3, 4, 5, 2.5, 40, -3]))))
            if rng.random() < 0.05:
                rows.append((f"s{s}", day, "TMAX", 1.0))
    rows += rows[:200]
    rows += [("s0", None, "MDPR", 1.0), ("x", datetime.date(2000, 1, 1), "MDPR", None), ("x", datetime.date(2000, 1, 2), "DAPR", 3.0)]
    totals = wl.multiday_totals(frame(spark, rows))
    got = {(r.id, r.date): (r.value, r.days, r.n_observed, r.n_shared, r.failed) for r in totals.collect()}
    want = plain_totals(rows)
    assert got == want and {True, False} == {v[-1] for v in want.values()}
    spread = {(r.id, r.date): (r.element, r.value) for r in wl.spread_totals(totals).collect()}
    days = {
        (name, end - k * ONE): ("PRCP", f32(amount / length))
        for (name, end), (amount, length, _, _, failed) in want.items()
        if not failed
        for k in range(int(length))
    }
    assert spread == days
    assert wl.multiday_totals(frame(spark, rows).limit(0)).count() == 0


def test_multiday_elements_do_not_meet(spark):
    day = datetime.date(2001, 3, 10)
    rows = [("a", day, "MDSF", 9.0), ("a", day, "DASF", 3.0), ("a", day - ONE, "PRCP", 1.0),
            ("a", day, "MDPR", 4.0), ("a", day, "DAPR", 1.0)]
    got = {r.element: (r.failed, r.first_date) for r in wl.multiday_totals(frame(spark, rows)).collect()}
    assert got == {"MDSF": (False, day - 2 * ONE), "MDPR": (True, None)}


def plain_streaks(rows, least, leave_out=None):
    cells = {}
    for name, date, element, value in rows:
        if date is not None and value is not None and value != leave_out:
            key = (name, element, date)
            cells[key] = max(value, cells.get(key, value))
    out, run = [], None
    for (name, element, date), value in sorted(cells.items()):
        if run and run[:3] == [name, element, value]:
            run[4:] = [date, run[5] + 1]
        else:
            run = [name, element, value, date, date, 1]
            out.append(run)
    return sorted(tuple(r) for r in out if r[5] >= least)


def test_streaks(spark):
    """Within years, across several, over years of one run, over gaps of years."""
    rng = random.Random(8)
    rows = []
    for s in range(5):
        value, day = 0.0, datetime.date(1998, 11, 1)
        for _ in range(1500):
            if rng.random() < (0.02 if s < 3 else 0.3):
                value = f32(rng.choice([0, 1.5, 2, -3]))
            if rng.random() < 0.7:
                rows.append((f"s{s}", day, "PRCP", value))
            day += ONE if rng.random() < 0.995 else 500 * ONE
    rows += [("long", datetime.date(1990 + k, 6, 1), "TMAX", 7.0) for k in range(9)]
    rows += [("turn", datetime.date(2000, 12, 31), "TMAX", 1.0), ("turn", datetime.date(2001, 1, 1), "TMAX", 1.0)]
    rows += rows[:100] + [("s0", None, "PRCP", 1.0), ("s0", datetime.date(1998, 11, 2), "PRCP", None)]
    for least, leave_out in ((1, None), (2, None), (5, 0.0)):
        found = wl.streaks(frame(spark, rows), least, leave_out)
        got = sorted((r.id, r.element, r.value, r.first_date, r.last_date, r.n_values) for r in found.collect())
        assert got == plain_streaks(rows, least, leave_out)
    assert wl.streaks(frame(spark, rows).limit(0)).count() == 0


def test_frequent_values(spark):
    rng = random.Random(12)
    rows = [
        (f"s{s}", datetime.date(2000, 1, 1) + k * ONE, "PRCP", f32(rng.choice([0, 0, 0, 1.5, 2, 3, 4])))
        for s in range(3)
        for k in range(800)
    ]
    rows += rows[:99]
    cells = {(n, d): v for n, d, _, v in rows}
    for leave_out in (None, 0.0):
        counts = Counter((n, d.month, v) for (n, d), v in cells.items() if v != leave_out)
        whole = Counter()
        for (n, m, _), c in counts.items():
            whole[n, m] += c
        want = {(n, m, v, c, whole[n, m]) for (n, m, v), c in counts.items() if whole[n, m] >= 10 and c >= 0.3 * whole[n, m]}
        got = wl.frequent_values(frame(spark, rows), 0.3, 10, leave_out)
        assert {(r.id, r.month, r.value, r.n_values, r.n_all) for r in got.collect()} == want and want
