"""What must not grow with the input: rows of a task, calls to the state, state stores, caches."""

import datetime as dt
import os
import uuid

from pyspark.sql import Row
from pyspark.sql import functions as F

from rillhouse.live.run import drain
from rillhouse.live import state
from rillhouse.operators.windows import windowed_agg
from workload import queries as Q

from conftest import DATA

T0 = dt.datetime(2024, 1, 1)


def folders(monkeypatch, tmp_path):
    """Where staged files go, by label."""
    made = {}

    def scratch(spark, label):
        made[label] = f"{tmp_path}/{label}-{uuid.uuid4().hex}"
        return made[label]
    monkeypatch.setattr(Q.paths, "scratch", scratch)
    return made


def parts(folder):
    return [f for f in os.listdir(folder) if f.startswith("part-")]


def test_staged_messages_get_files_by_their_rows(spark, tmp_path, monkeypatch):
    made = folders(monkeypatch, tmp_path)
    rows = spark.range(101).select(F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    stream = Q.message_files(rows, "messages", file_rows=10)
    assert len(parts(made["messages"])) == 12           # four micro-batches of three files
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
             .trigger(availableNow=True).start(f"{tmp_path}/t"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    got = spark.read.parquet(f"{tmp_path}/t").select(F.col("value").cast("int")).collect()
    assert sorted(r[0] for r in got) == list(range(101))


def test_costly_streams_read_small_files(spark, tmp_path, monkeypatch):
    made = folders(monkeypatch, tmp_path)
    monkeypatch.setattr(Q, "SMALL_FILE_ROWS", 100, raising=False)
    Q.QUERIES["stream_log_pages"](spark, DATA)
    rows = spark.read.parquet(f"{DATA}/events.parquet").count()
    assert len(parts(made["event-files"])) >= rows // 100


class Handle:
    """A state store that counts the calls made to it."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def getExpiryTimeInMs(self):
        return self.timers[-1]


def test_keys_of_a_slot_share_the_calls_to_the_state():
    handle, slots = Handle(), state.DaySlots(1, ["ts", "day"], 24)
    slots.init(handle)
    rows = [Row(7, f"k{k}", T0 + dt.timedelta(days=d), d) for k in range(500) for d in (1, 0, 1)]
    made = [tuple(r) for r in slots.handleInputRows((7,), iter(rows), None)]
    assert made == [x for k in range(500) for x in (
        (f"k{k}", T0, 0, None), (f"k{k}", T0 + dt.timedelta(days=1), 1, 0))]
    assert handle.calls == 3
    again = [tuple(r) for r in slots.handleInputRows((7,), iter(rows[:1] + [Row(7, "k1", T0, 2)]), None)]
    assert again == [("k1", T0, 2, 1)]                   # a day held is not given out again
    assert list(slots.handleExpiredTimer((7,), None, handle)) == [] and handle.value is None


def test_a_stream_keeps_stores_by_cores(spark, tmp_path):
    path, before = f"{tmp_path}/in", spark.conf.get("spark.sql.shuffle.partitions")
    spark.createDataFrame([(T0,), (T0 + dt.timedelta(hours=3),)], "ts timestamp").write.parquet(path)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        stream = spark.readStream.schema("ts timestamp").parquet(path)
        counted = windowed_agg(stream, "ts", "1 hour", [F.count("*").alias("n")], delay="1 minute")
        assert drain(counted, f"{tmp_path}/t", f"{tmp_path}/c").count() == 1
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = spark.read.format("state-metadata").load(f"{tmp_path}/c").first().numPartitions
    assert stores == 2 * spark.sparkContext.defaultParallelism < 40
