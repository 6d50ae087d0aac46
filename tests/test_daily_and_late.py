"""Daily-first rules by table, late rows, sketches, narrow slots, state read as a table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.live import daily, late
from rillhouse.live.run import drain, observed_totals, state_rows
from rillhouse.operators import sketches
from rillhouse.operators.joins import interval_join
from rillhouse.operators.visits import first_of_day
from rillhouse.plans import metrics
from rillhouse.sources import readers, tables
from test_streams import stream_of
from test_visits import by_one, visits

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, kind string"


def test_first_rows_by_table_are_those_of_the_processor(spark, tmp_path):
    rows = sorted(visits(21, n=400), key=lambda r: r[1])
    store = daily.visit_store(f"{tmp_path}/days", {"k": T.StringType()}, buckets=3)
    got = []
    for n in range(4):
        batch = spark.createDataFrame(rows[n * 100:(n + 1) * 100], SCHEMA).cache()
        made = [tuple(r) for r in daily.first_of_day_batch(batch, n, store, "ts", ["kind"]).collect()]
        again = [tuple(r) for r in daily.first_of_day_batch(batch, n, store, "ts", ["kind"]).collect()]
        assert sorted(made, key=str) == sorted(again, key=str)          # a replay gives the same rows
        got += made
    assert sorted(got, key=str) == by_one(rows)
    assert store.read(spark).count() == len({r[0] for r in rows})       # one row a key, however many days


def test_page_views_by_table_and_by_state(spark, tmp_path):
    rng = random.Random(4)
    rows = [(T0 + dt.timedelta(minutes=i * 7), rng.choice(["m1", "m2", "m3", None]), rng.choice("ab"), "app", "v1",
             "0", rng.choice([None, "home"]), rng.choice(["1.5", "x", None])) for i in range(600)]
    schema = ("ts timestamp, mid string, ar string, ch string, vc string, is_new string, last_page_id string, "
              "during_time string")
    store = daily.visit_store(f"{tmp_path}/days", {"mid": T.StringType()}, buckets=2)
    stream = stream_of(spark, tmp_path, rows, schema, 5)
    daily.increments_stream(stream, lambda b, n: metrics.page_view_increments(b, n, store), f"{tmp_path}/inc",
                            f"{tmp_path}/inc-c", available_now=True).awaitTermination()
    made = readers.table_stream(spark, f"{tmp_path}/inc", T.StructType.fromDDL(
        metrics.PAGE_VIEW_INCREMENTS + ", batch long"), max_files=1).drop("batch")
    got = drain(metrics.page_view_windows(made, "1 hour"), f"{tmp_path}/t", f"{tmp_path}/c")
    end = (rows[-1][0] - dt.timedelta(seconds=3)).strftime("%Y-%m-%d %H:%M:%S")
    want = metrics.page_views(spark.createDataFrame(rows, schema), "1 hour").where(F.col("endTime") <= end)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_late_rows_are_told_apart(spark, tmp_path):
    marks = late.high_marks(f"{tmp_path}/marks")

    def told(n, *minutes):
        batch = spark.createDataFrame([(m, None if m is None else T0 + dt.timedelta(minutes=m)) for m in minutes],
                                      "m int, ts timestamp").cache()
        return {r.m: r.late for r in late.with_late(batch, n, marks, "ts", "10 minutes").collect()}

    assert told(0, 0, 30, 100, None) == {0: False, 30: False, 100: False, None: True}
    for _ in range(2):                                           # and replayed
        assert told(1, 89, 90, 91, 300, None) == {89: True, 90: True, 91: False, 300: False, None: True}
    assert told(2, 200) == {200: True}
    assert told(3, 290, 291) == {290: True, 291: False}          # an older batch's mark holds on


def test_sketches_unite(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 3000).alias("user"), F.col("id").cast("string").alias("k"),
        (F.lit(T0).cast("timestamp") + F.make_interval(mins=(F.col("id") % 2880).cast("int"))).alias("ts"))
    stored = sketches.windowed_sketches(rows.withColumn("p", F.col("user") % 2), "ts", "1 hour", "user", ["p"])
    whole = sketches.united(stored, []).select(sketches.estimate().alias("n")).first().n
    days = sketches.united(stored, ["date"]).select(sketches.within_error(
        sketches.estimate(), F.lit(3000)).alias("near"), sketches.estimate().alias("n")).collect()
    assert abs(whole - 3000) <= 4 * 1.04 / 64 * 3000
    assert len(days) == 2
    one = sketches.windowed_sketches(rows.where("user < 3"), "ts", "1 hour", "user")
    assert sketches.united(one, []).select(sketches.estimate()).first()[0] == 3


@pytest.mark.parametrize("how", ["inner", "left"])
def test_narrow_slots_spread_a_hot_key(spark, how):
    rng = random.Random(6)
    at = lambda: T0 + dt.timedelta(seconds=rng.randint(0, 7200))
    key = lambda: "hot" if rng.random() < 0.34 else f"k{rng.randint(0, 40)}"
    left = spark.createDataFrame([(i, key(), at()) for i in range(600)], "l int, k string, t timestamp")
    right = spark.createDataFrame([(i, key(), at()) for i in range(300)], "r int, rk string, rt timestamp")

    def joined(**slots):
        return interval_join(left, right, "k", "rk", "t", "rt", -300, 900, how, ["r"], **slots)

    want = sorted(map(tuple, joined(split_hot_keys=False).select("l", "r").collect()), key=str)
    for width in (None, 60, 7, 1200, 5000):
        assert sorted(map(tuple, joined(slot_seconds=width).select("l", "r").collect()), key=str) == want
    by_slot = (left.where("k = 'hot'").groupBy(F.floor(F.unix_seconds("t") / 60)).count()
               .agg(F.max("count"), F.count("*")).first())
    assert by_slot[1] > 50 and by_slot[0] < 20       # the hot key's rows lie in many small groups


def test_state_is_read_and_expires(spark, tmp_path):
    rows = [("a", T0, "x"), ("b", T0 + dt.timedelta(hours=1), "x"), ("c", T0 + dt.timedelta(days=9), "x"),
            ("d", T0 + dt.timedelta(days=9, hours=1), "x")]
    stream = stream_of(spark, tmp_path, rows, SCHEMA, 4)
    for name, ttl in (("kept", None), ("short", 24)):
        drain(first_of_day(stream, "k", "ts", ["kind"], ttl_hours=ttl), f"{tmp_path}/{name}", f"{tmp_path}/{name}-c")
        held = state_rows(spark, f"{tmp_path}/{name}-c", "transformWithState", "last_day")
        keys = {r[0] for r in held.select("key._k0").collect()}
        assert keys == ({"a", "b", "c", "d"} if ttl is None else {"c", "d"})
    with pytest.raises(LookupError):
        state_rows(spark, f"{tmp_path}/kept-c", "join")


def test_observed_totals_over_micro_batches(spark, tmp_path):
    rows = [(f"k{i}", T0 + dt.timedelta(minutes=i), "x" if i % 3 else "y") for i in range(60)]
    watched = stream_of(spark, tmp_path, rows, SCHEMA, 4).observe(
        "seen", F.count_if(F.col("kind") == "x").alias("x"), F.count_if(F.col("kind") == "y").alias("y"))
    query = tables.append_stream(watched, f"{tmp_path}/t", f"{tmp_path}/c", None, available_now=True)
    query.awaitTermination()
    assert observed_totals(query, "seen") == {"x": 40, "y": 20}
    assert observed_totals(query, "other") == {}
