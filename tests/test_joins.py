import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rillhouse.operators.joins import (Hop, Interval, chain_interval_joins, interval_join, lookup,
                                       snowflake_lookup)

T0 = dt.datetime(2024, 1, 1)


def rows(rng, n, keys, spread=2000):
    return [(i, rng.choice(keys), T0 + dt.timedelta(seconds=rng.randrange(spread),
                                                    microseconds=rng.randrange(10**6)))
            for i in range(n)]


def brute(left, right, lower, upper, how):
    out = []
    for i, k, t in left:
        hits = [j for j, kk, tt in right
                if k is not None and k == kk and tt + dt.timedelta(seconds=lower) <= t
                <= tt + dt.timedelta(seconds=upper)]
        out += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    return sorted(out, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("lower,upper", [(-10, 10), (0, 900), (-30, -5), (0, 0)])
@pytest.mark.parametrize("split", [True, False])
def test_interval_join_equals_comparing_all_pairs(spark, how, lower, upper, split):
    rng = random.Random(lower * 31 + upper)
    keys = ["hot"] * 6 + ["a", "b", None]     # one key holds most of the rows
    left, right = rows(rng, 120, keys), rows(rng, 120, keys)
    right += [(1000 + i, k, t) for i, k, t in left[:20]]          # exact hits
    a = spark.createDataFrame(left, "i int, k string, t timestamp")
    b = spark.createDataFrame(right, "j int, k string, t timestamp")
    got = interval_join(a, b, "k", "k", "t", "t", lower, upper, how, split_hot_keys=split)
    assert got.columns == ["i", "k", "t", "j"]
    assert sorted([(r.i, r.j) for r in got.collect()], key=str) == brute(left, right, lower, upper, how)


def test_chain_multiplies_matches_and_keeps_unmatched(spark):
    at = T0 + dt.timedelta(seconds=5)
    a = spark.createDataFrame([("o1", at), ("o2", at)], "o string, t timestamp")
    b = spark.createDataFrame([("o1", "p1", at), ("o2", "p2", at)], "id string, p string, t timestamp")
    c = spark.createDataFrame([("o1", "x", at), ("o1", "y", at)], "o string, c string, t timestamp")
    d = spark.createDataFrame([("o1", "q", at), ("o1", "r", at)], "o string, d string, t timestamp")
    got = chain_interval_joins(a, "o", "t", [
        Interval(b, "id", "t", -10, 10), Interval(c, "o", "t", -10, 10, "left"),
        Interval(d, "o", "t", -10, 10, "left")])
    assert sorted([(r.o, r.p, r.c, r.d) for r in got.collect()], key=str) == sorted([
        ("o1", "p1", "x", "q"), ("o1", "p1", "x", "r"), ("o1", "p1", "y", "q"),
        ("o1", "p1", "y", "r"), ("o2", "p2", None, None)], key=str)


def test_chain_shares_the_left_shuffle(spark):
    """Joins on one key and slot do not shuffle the joined rows again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = spark.range(100).select(F.col("id").cast("string").alias("k"),
                                        F.timestamp_seconds("id").alias("t"), F.col("id").alias("v"))
        side = lambda name: Interval(frame.withColumnRenamed("v", name), "k", "t", -5, 5, "left")
        got = chain_interval_joins(frame, "k", "t", [side("a"), side("b"), side("c")])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4     # one per input
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_default_and_snowflake(spark):
    facts = spark.createDataFrame([("1",), ("2",), (None,)], "sku string")
    sku = spark.createDataFrame([("1", "pen", "b1")], "id string, name string, brand string")
    brand = spark.createDataFrame([("b1", "Acme")], "id string, name string")
    named = lookup(facts, sku, "sku", "id", {"name": "sku_name"}, default="")
    assert sorted(r.sku_name for r in named.collect()) == ["", "", "pen"]
    two = snowflake_lookup(facts, [Hop(sku, "sku", "id", {"name": "n", "brand": "b"}),
                                   Hop(brand, "b", "id", {"name": "brand_name"})])
    assert sorted([(r.sku, r.n, r.brand_name) for r in two.collect()], key=str) == sorted(
        [("1", "pen", "Acme"), ("2", None, None), (None, None, None)], key=str)
