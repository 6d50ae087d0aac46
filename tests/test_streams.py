"""Streams against their batch form: same rows whatever the micro-batches."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.operators.visits import first_of_day
from rillhouse.operators.windows import windowed_agg
from rillhouse.plans import metrics
from rillhouse.live.run import drain
from rillhouse.live.state import accept_and_flag_stream, device_store, flag_batch

from test_visits import T0, by_one, device_by_one, visits

SCHEMA = "k string, ts timestamp, kind string"


def stream_of(spark, folder, rows, schema, files):
    """Rows written in order as ``files`` files, read back one file per micro-batch."""
    path = f"{folder}/in-{uuid.uuid4().hex}"
    size = -(-len(rows) // files)
    for at in range(files):
        part = rows[at * size:(at + 1) * size]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(df, folder):
    at = f"{folder}/out-{uuid.uuid4().hex}"
    return drain(df, f"{at}/table", f"{at}/checkpoint")


@pytest.mark.parametrize("files,salts", [(1, 1), (5, 1), (3, 4)])
def test_first_of_day_in_any_micro_batches(spark, tmp_path, files, salts):
    rows = sorted(visits(3, n=400), key=lambda r: (r[1], r[2] is not None, r[2] or ""))
    stream = stream_of(spark, tmp_path, rows, SCHEMA, files)
    got = run(first_of_day(stream, "k", "ts", ["kind"], salts=salts), tmp_path)
    assert sorted(map(tuple, got.collect()), key=str) == by_one(rows)


def test_forgetting_old_days_keeps_the_daily_rule(spark, tmp_path):
    rows = sorted(visits(4, n=300), key=lambda r: (r[1], r[2] is not None, r[2] or ""))
    stream = stream_of(spark, tmp_path, rows, SCHEMA, 4)
    got = run(first_of_day(stream, "k", "ts", ttl_hours=1).select("k", "ts", "visit_date"), tmp_path)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(k, ts, day) for k, ts, _, day, _ in by_one(rows)], key=str)


def test_large_key_in_one_batch(spark, tmp_path):
    rows = sorted([("hot", T0 + dt.timedelta(seconds=s), "x") for s in range(0, 3 * 86400, 20)],
                  key=lambda r: r[1])
    got = run(first_of_day(stream_of(spark, tmp_path, rows, SCHEMA, 1), "k", "ts"), tmp_path)
    assert got.count() == 3


@pytest.mark.parametrize("files", [1, 2, 5])
@pytest.mark.parametrize("trust", [False, True])
def test_device_rule_in_any_micro_batches(spark, tmp_path, files, trust):
    rng, clock, rows = random.Random(5), T0 + dt.timedelta(hours=23, minutes=55), []
    for arrival in range(300):
        clock += dt.timedelta(seconds=rng.randrange(4))
        late = dt.timedelta(seconds=rng.choice([0, 0, 4, 5, 6, 30]))
        rows.append((rng.choice(["a", "b"]), arrival, clock - late, rng.choice(["0", "1"])))
    stream = stream_of(spark, tmp_path, rows, "mid string, arrival long, ts timestamp, is_new string", files)
    got = run(accept_and_flag_stream(stream, "mid", "ts", trust_reported_old=trust), tmp_path)
    want = device_by_one(rows, trust=trust)
    assert sorted((r.mid, r.arrival, r.is_new) for r in got.collect()) == want


@pytest.mark.parametrize("trust", [False, True])
def test_device_rule_with_records_in_a_table(spark, tmp_path, trust):
    rng, clock, rows = random.Random(6), T0 + dt.timedelta(hours=23, minutes=55), []
    for arrival in range(300):
        clock += dt.timedelta(seconds=rng.randrange(4))
        late = dt.timedelta(seconds=rng.choice([0, 0, 4, 5, 6, 30]))
        rows.append((rng.choice(["a", "b"]), arrival, clock - late, rng.choice(["0", "1"])))
    store, got = device_store(f"{tmp_path}/devices", "mid", T.StringType()), []
    for n, at in enumerate(range(0, 300, 60)):
        part = rows[at:at + 60]
        rng.shuffle(part)        # the arrival number, not the place, is the order
        batch = spark.createDataFrame(part, "mid string, arrival long, ts timestamp, is_new string")
        for _ in range(2):       # every batch is replayed once
            accepted = flag_batch(batch, n, store, "ts", "arrival", trust_reported_old=trust).collect()
        got += [(r.mid, r.arrival, r.is_new) for r in accepted]
        if n == 3:
            store.compact(spark, before=n)
    assert sorted(got) == device_by_one(rows, trust=trust)


def pages(rows):
    rng = random.Random(9)
    return [(k, rng.choice(["home", None]), f"ar{rng.randrange(2)}", "ch", "v1", "1", ts,
             rng.choice(["12.5", "7", "bad", None])) for k, ts, _ in rows]


PAGES = ("mid string, last_page_id string, ar string, ch string, vc string, is_new string, "
         "ts timestamp, during_time string")


def test_page_views_stream_equals_batch_for_closed_windows(spark, tmp_path):
    rows = pages(sorted(visits(6, n=500), key=lambda r: r[1]))
    batch = metrics.page_views(spark.createDataFrame(rows, PAGES), "1 hour")
    stream = run(metrics.page_views(stream_of(spark, tmp_path, rows, PAGES, 3), "1 hour", salts=3), tmp_path)
    limit = (max(r[6] for r in rows) - dt.timedelta(seconds=3)).strftime("%Y-%m-%d %H:%M:%S")
    want = batch.where(F.col("endTime") <= limit)
    assert want.count() > 300
    assert sorted(map(tuple, stream.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    # A batch drops what is behind the watermark its predecessor closed windows with.
    rows = [("a", at(1), "x"), ("a", at(100), "x"), ("a", at(150), "x"), ("a", at(200), "x"),
            ("a", at(2), "late"), ("a", at(300), "x")]
    stream = stream_of(spark, tmp_path, rows, SCHEMA, 3)
    got = run(windowed_agg(stream, "ts", "10 seconds", [F.count("*").alias("n")], delay="3 seconds"), tmp_path)
    counts = {r.startTime[-5:]: r.n for r in got.collect()}
    assert counts["00:00"] == 1
    assert counts["01:40"] == 1


def test_combine_before_the_shuffle(spark):
    from rillhouse.live.state import _first_in_each_task
    rows = visits(12, n=5000, keys=("hot",) * 9 + ("a",), days=3)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("visit_date", F.unix_date(F.to_date("ts")))
    fewer = _first_in_each_task(df, ["k"], "ts", ["kind"], "3 seconds")
    assert fewer.columns == ["k", "ts", "kind", "visit_date"]
    assert fewer.count() <= 4 * 2 * 3          # tasks × keys × days
    again = first_of_day(fewer.drop("visit_date"), "k", "ts", ["kind"])
    assert sorted(map(tuple, again.collect()), key=str) == by_one(rows)


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    rows = sorted(visits(8, n=300), key=lambda r: (r[1], r[2] is not None, r[2] or ""))
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(SCHEMA).parquet(path)
        got = drain(first_of_day(stream, "k", "ts", ["kind"]), f"{out}/table", f"{out}/checkpoint")
    assert sorted(map(tuple, got.collect()), key=str) == by_one(rows)


def test_sliding_windows_of_stream_and_batch(spark, tmp_path):
    rows = [(str(i), T0 + dt.timedelta(seconds=i * 3)) for i in range(60)]
    schema = "id string, create_time timestamp"
    batch = metrics.registrations(spark.createDataFrame(rows, schema))
    stream = run(metrics.registrations(stream_of(spark, tmp_path, rows, schema, 2)), tmp_path)
    limit = (rows[-1][1] - dt.timedelta(seconds=3)).strftime("%Y-%m-%d %H:%M:%S")
    want = sorted(map(tuple, batch.where(F.col("endTime") <= limit).collect()))
    assert sorted(map(tuple, stream.collect())) == want
    assert batch.agg(F.sum("registerCt")).first()[0] == 120      # each row in two windows
