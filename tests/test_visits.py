import datetime as dt
import random

import pytest

from rillhouse.operators.visits import (accept_and_flag, first_ever, first_of_day, returned_after)

T0 = dt.datetime(2024, 1, 1)


def visits(seed, n=600, keys=("hot", "hot", "hot", "a", "b", "c"), days=30):
    rng = random.Random(seed)
    return [(rng.choice(keys), T0 + dt.timedelta(seconds=rng.randrange(days * 86400)),
             rng.choice(["x", "y", None])) for _ in range(n)]


def by_one(rows):
    """The daily rule, one row at a time in time order."""
    last, out = {}, []
    for key, ts, kind in sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or "")):
        day = ts.date()
        if last.get(key) != day:
            out.append((key, ts, kind, day, last.get(key)))
            last[key] = day
    return sorted(out, key=str)


def test_first_of_day_equals_row_by_row(spark):
    rows = visits(1)
    df = spark.createDataFrame(rows, "k string, ts timestamp, kind string")
    got = first_of_day(df, "k", "ts", ["kind"])
    assert got.columns == ["k", "ts", "kind", "visit_date", "previous_date"]
    assert sorted(map(tuple, got.collect()), key=str) == by_one(rows)


def test_equal_times_are_ordered_by_kept_values_nulls_first(spark):
    rows = [("a", T0, "y"), ("a", T0, None), ("a", T0, "x")]
    df = spark.createDataFrame(rows, "k string, ts timestamp, kind string")
    assert [r.kind for r in first_of_day(df, "k", "ts", ["kind"]).collect()] == [None]


def test_gap_is_more_than_seven_days(spark):
    rows = [("a", T0 + dt.timedelta(days=d), "x") for d in (0, 7, 15, 15, 16)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, kind string")
    got = first_of_day(df, "k", "ts").withColumns(
        {"back": returned_after(7), "fresh": first_ever()}).orderBy("ts").collect()
    assert [r.back for r in got] == [0, 0, 1, 0]
    assert [r.fresh for r in got] == [1, 0, 0, 0]


def test_no_window_over_raw_rows(spark):
    """The rows of a key are reduced before any window orders them."""
    df = spark.createDataFrame(visits(2), "k string, ts timestamp, kind string")
    plan = first_of_day(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate")     # the window sits on top


def device_by_one(rows, late=5, trust=False):
    state, out = {}, []
    for key, arrival, ts, flag in sorted(rows, key=lambda r: r[1]):
        second, day = ts.replace(microsecond=0), ts.date()
        if key in state:
            first, newest = state[key]
            if (newest - second).total_seconds() > late:
                continue
            state[key] = (first, max(newest, second))
        else:
            first = day - dt.timedelta(days=1) if trust and flag == "0" else day
            state[key] = (first, second)
        out.append((key, arrival, "1" if day == state[key][0] else "0"))
    return sorted(out)


@pytest.mark.parametrize("trust", [False, True])
@pytest.mark.parametrize("chunk", [1, 7, 10_000])
def test_device_rule_equals_row_by_row(spark, trust, chunk):
    rng = random.Random(chunk)
    rows, clock = [], T0 + dt.timedelta(hours=23, minutes=50)
    for arrival in range(400):
        clock += dt.timedelta(seconds=rng.randrange(4))
        jitter = dt.timedelta(seconds=rng.choice([0, 0, 3, 5, 6, 20]), microseconds=rng.randrange(10**6))
        rows.append((rng.choice(["hot", "hot", "a"]), arrival, clock - jitter, rng.choice(["0", "1"])))
    df = spark.createDataFrame(rows, "mid string, arrival long, ts timestamp, is_new string")
    got = accept_and_flag(df, "mid", "ts", "arrival", trust_reported_old=trust, chunk_rows=chunk)
    assert got.columns == df.columns
    assert sorted((r.mid, r.arrival, r.is_new) for r in got.collect()) == device_by_one(rows, trust=trust)
