import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse.operators.merge import UPSERT
from rillhouse.plans.dimension import with_order
from rillhouse.sources import paths, readers, tables


def frame(spark, rows, schema="k string, date string, n int"):
    return spark.createDataFrame(rows, schema)


def content(df):
    return sorted((r.k, r.n) for r in df.collect())


def test_keyed_table_newest_batch_wins_and_replay_is_harmless(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k", "date"])
    store.put(frame(spark, [("a", "d1", 1), ("b", "d1", 1)]), 0)
    for _ in range(2):
        store.put(frame(spark, [("a", "d1", 2), ("c", "d2", 5)]), 1)
    assert content(store.read(spark)) == [("a", 2), ("b", 1), ("c", 5)]
    assert content(store.read(spark, F.col("date") == "d2")) == [("c", 5)]
    with pytest.raises(ValueError):
        store.put(frame(spark, [("a", "d1", 0)]), 0)


def test_keyed_table_reads_only_the_partitions_asked_for(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k", "date"])
    store.put(frame(spark, [("a", "d1", 1), ("b", "d2", 1)]), 0)
    plan = store.read(spark, F.col("date") == "d2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_keyed_table_removal_and_compaction(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None, keep_hours=0)
    store.put(frame(spark, [("a", "d", 1), ("b", "d", 1)]), 0)
    gone = frame(spark, [("a", "d", 1)]).withColumn("_removed", F.lit(True))
    store.put(gone, 1, gone="_removed")
    assert content(store.read(spark)) == [("b", 1)]
    store.compact(spark)
    assert paths.children(spark, f"{tmp_path}/t") == ["part=c000000000001"]
    assert content(store.read(spark)) == [("b", 1)]
    store.put(frame(spark, [("a", "d", 7)]), 2)
    store.put(frame(spark, [("a", "d", 8)]), 3)
    store.compact(spark)                      # folds the new batches only
    assert paths.children(spark, f"{tmp_path}/t") == ["part=c000000000001", "part=c000000000003"]
    assert content(store.read(spark)) == [("a", 8), ("b", 1)]
    store.compact(spark, full=True)
    assert paths.children(spark, f"{tmp_path}/t") == ["part=f000000000003"]
    assert content(store.read(spark)) == [("a", 8), ("b", 1)]
    asked = spark.createDataFrame([("b",), ("b",), ("zz",)], "who string")
    assert content(store.read_for(asked, "who")) == [("b", 1)]


def files_opened(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_bucketed_reads_open_the_buckets_asked_for(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], None, buckets=32)
    rows = [(f"k{i}", "d", i) for i in range(3000)]
    store.put(frame(spark, rows), 0)
    store.put(frame(spark, [(f"k{i}", "d", -i) for i in range(0, 3000, 2)]), 1)
    want = {k: -n if n % 2 == 0 else n for k, _, n in rows}
    assert dict(content(store.read(spark))) == want
    asked = spark.createDataFrame([(f"k{i * 37}",) for i in range(10)] + [(None,), ("zz",)], "who string")
    found = store.read_for(asked, "who")
    assert dict(content(found)) == {f"k{i * 37}": want[f"k{i * 37}"] for i in range(10)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    listed = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_bucket" in listed and "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,k0)" in plan
    numbers = {r[0] for r in asked.select(tables.bucket_of(["who"], 32)).distinct().collect()}
    assert len(numbers) <= 12
    scanned = store.stored(spark).where(F.col("_bucket").isin(list(numbers)))
    assert {f.split("_bucket=")[1].split("/")[0] for f in files_opened(scanned)} <= {str(n) for n in numbers}
    assert content(store.read_for(asked.where("who is null"), "who")) == []
    store.compact(spark)
    assert dict(content(store.read(spark))) == want
    assert dict(content(store.read_for(asked, "who"))) == dict(content(found))
    numbers_ = tables.KeyedTable(f"{tmp_path}/n", ["n"], None, buckets=4)   # asked for in another type
    numbers_.put(frame(spark, rows[:50]), 0)
    assert content(numbers_.read_for(spark.createDataFrame([("7",)], "who string"), "who")) == [("k7", 7)]
    with pytest.raises(ValueError):
        tables.KeyedTable(f"{tmp_path}/t", ["k", "date"], buckets=4)


def test_a_read_begun_before_a_fold_still_finds_its_files(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None)
    for n in range(3):
        store.put(frame(spark, [("a", "d", n), (f"k{n}", "d", n)]), n)
    held = store.read(spark)
    store.compact(spark)
    store.put(frame(spark, [("a", "d", 7)]), 3)
    store.compact(spark, full=True)
    assert content(held) == [("a", 2), ("k0", 0), ("k1", 1), ("k2", 2)]
    assert dict(content(store.read(spark)))["a"] == 7
    assert store.version(spark) == 3


def test_compaction_stopped_half_way_leaves_a_correct_table(spark, tmp_path, monkeypatch):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None, keep_hours=0)
    for n in range(3):
        store.put(frame(spark, [("a", "d", n), (f"k{n}", "d", n)]), n)
    want = content(store.read(spark))

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(paths, "remove", stop)
    with pytest.raises(RuntimeError):
        store.compact(spark)
    monkeypatch.undo()
    assert content(store.read(spark)) == want
    store.put(frame(spark, [("a", "d", 9)]), 3)
    store.compact(spark)
    assert dict(content(store.read(spark)))["a"] == 9


def test_a_torn_fold_is_written_again(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None, keep_hours=0)
    for n in range(3):
        store.put(frame(spark, [(f"k{n}", "d", n)]), n)
    torn = tmp_path / "t" / "part=c000000000002"
    torn.mkdir()
    (torn / "part-0.parquet").write_bytes(b"half a file")
    assert len(content(store.read(spark))) == 3
    store.compact(spark)
    assert paths.children(spark, f"{tmp_path}/t") == ["part=c000000000002"]
    assert content(store.read(spark)) == [("k0", 0), ("k1", 1), ("k2", 2)]


def test_folds_are_counted_by_stored_batches(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None, keep_hours=0)
    for n in (7, 55, 113, 298):   # all the batches between were empty
        store.compact_every(spark, n, batches=3)
        store.put(frame(spark, [(f"k{n}", "d", n)]), n)
    assert paths.children(spark, f"{tmp_path}/t") == ["part=b000000000298", "part=c000000000113"]
    assert len(content(store.read(spark))) == 4


def test_keyed_table_with_a_column_added_later(spark, tmp_path):
    first = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None)
    first.put(spark.createDataFrame([("a", "1")], "k string, x string"), 0)
    wider = tables.KeyedTable(f"{tmp_path}/t", ["k"], None,
                              T.StructType.fromDDL("k string, x string, y string"))
    wider.put(spark.createDataFrame([("b", "2", "3")], "k string, x string, y string"), 1)
    assert sorted(map(tuple, wider.read(spark).collect())) == [("a", "1", None), ("b", "2", "3")]


def test_a_batch_that_did_not_commit_is_not_read(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None)
    store.put(frame(spark, [("a", "d", 1)]), 0)
    store.put(frame(spark, [("a", "d", 2)]), 1)
    os.remove(f"{tmp_path}/t/part=b000000000001/_SUCCESS")
    assert content(store.read(spark)) == [("a", 1)]


SCHEMA = T.StructType().add("k", "string").add("n", T.IntegerType())


def changes(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, seq int, type string")


def test_merged_table_versions_replay_and_new_column(spark, tmp_path):
    store = tables.MergedTable(f"{tmp_path}/t", SCHEMA)
    store.create_if_absent(spark)
    assert store.read(spark).count() == 0
    store.merge(changes(spark, [("a", 1, 1, "insert"), ("b", 1, 2, "insert")]), 0, "k", ["seq"])
    for _ in range(2):
        store.merge(changes(spark, [("a", 2, 3, "update"), ("b", 0, 4, "delete")]), 1, "k", ["seq"])
    assert content(store.read(spark)) == [("a", 2)]
    wider = tables.MergedTable(f"{tmp_path}/t", T.StructType.fromDDL("k string, n int, extra string"),
                               keep_hours=0)
    more = changes(spark, [("c", 3, 5, "insert")]).withColumn("extra", F.lit("e"))
    wider.merge(more, 2, "k", ["seq"])
    assert sorted((r.k, r.extra) for r in wider.read(spark).collect()) == [("a", None), ("c", "e")]
    narrow = tables.MergedTable(f"{tmp_path}/t", SCHEMA)               # a column no longer declared stays
    assert sorted((r.k, r.extra) for r in narrow.read(spark).collect()) == [("a", None), ("c", "e")]
    with pytest.raises(ValueError):
        store.merge(changes(spark, []), 0, "k", ["seq"])


def test_merges_write_only_buckets_with_a_changed_key(spark, tmp_path):
    store = tables.MergedTable(f"{tmp_path}/t", SCHEMA, buckets=8)
    store.merge(changes(spark, [(f"k{i}", i, i, "insert") for i in range(100)]), 0, "k", ["seq"])
    held = store.read(spark)
    before = files_opened(held)
    few = changes(spark, [("k1", -1, 200, "update"), ("k2", 0, 201, "delete"), ("new", 5, 202, "insert"),
                          ("stray", 5, 203, "update"), (None, 5, 204, "insert")])
    for _ in range(2):                                                   # and again: the same rows
        store.merge(few, 1, "k", ["seq"])
        want = {**{f"k{i}": i for i in range(100) if i != 2}, "k1": -1, "new": 5}
        assert dict(content(store.read(spark))) == want
    touched = {r[0] for r in few.where("k is not null").select(tables.bucket_of(["k"], 8)).collect()}
    after = files_opened(store.read(spark))
    assert {f.split("_bucket=")[1][0] for f in after - before} <= {str(b) for b in touched}
    assert {f.split("_bucket=")[1][0] for f in before & after} == {str(b) for b in set(range(8)) - touched}
    store.merge(changes(spark, [("k3", -3, 300, "update")]), 2, "k", ["seq"])
    assert dict(content(held))["k1"] == 1                    # a held frame survives two merges
    asked = spark.createDataFrame([("k1",), ("k2",), ("none",)], "who string")
    assert content(store.read_for(asked, "who", "k")) == [("k1", -1)]
    assert store.version(spark) == 3


def test_a_bucket_that_is_emptied_stays_empty(spark, tmp_path):
    store = tables.MergedTable(f"{tmp_path}/t", SCHEMA, buckets=2, keep_hours=0)
    store.merge(changes(spark, [("a", 1, 1, "insert"), ("b", 1, 2, "insert")]), 0, "k", ["seq"])
    store.merge(changes(spark, [("a", 1, 3, "delete"), ("b", 1, 4, "delete")]), 1, "k", ["seq"])
    assert store.read(spark).count() == 0
    store.merge(changes(spark, [("a", 9, 5, "insert"), ("b", 9, 6, "insert")]), 2, "k", ["seq"])
    assert content(store.read(spark)) == [("a", 9), ("b", 9)]
    assert paths.children(spark, f"{tmp_path}/t") == ["v=000000000003"]      # older ones are covered


def test_a_stopped_merge_leaves_the_table_as_it_was(spark, tmp_path):
    store = tables.MergedTable(f"{tmp_path}/t", SCHEMA)
    store.merge(changes(spark, [("a", 1, 1, "insert")]), 0, "k", ["seq"])
    store.merge(changes(spark, [("a", 2, 2, "update")]), 1, "k", ["seq"])
    os.remove(f"{tmp_path}/t/v=000000000002/_SUCCESS")
    assert content(store.read(spark)) == [("a", 1)]
    store.merge(changes(spark, [("a", 2, 2, "update")]), 1, "k", ["seq"])
    assert content(store.read(spark)) == [("a", 2)]


def test_merged_table_partition_values_keep_their_type(spark, tmp_path):
    store = tables.MergedTable(f"{tmp_path}/t", T.StructType.fromDDL("k string, p string"), "p")
    rows = spark.createDataFrame([("a", "007", 1, "update")], "k string, p string, seq int, type string")
    store.merge(rows, 0, "k", ["seq"], policy=UPSERT)
    assert [tuple(r) for r in store.read(spark).select("k", "p").collect()] == [("a", "007")]


def test_append_batch_skips_empty_and_replaces_its_own_replay(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not tables.append_batch(frame(spark, []), path)
    assert not os.path.exists(path)
    for _ in range(2):
        assert tables.append_batch(frame(spark, [("a", "d1", 1)]), path, batch_id=0)
    assert tables.append_batch(frame(spark, [("b", "d1", 1)]), path, batch_id=1)
    assert content(spark.read.parquet(path)) == [("a", 1), ("b", 1)]


def data_files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def texts_of(spark, path):
    """Rows as they are stored, partition values as texts."""
    rows = spark.read.schema("k string, n int, date string").parquet(path)
    return sorted(map(tuple, rows.select("k", "n", "date").collect()))


def test_compact_files_keeps_rows_and_other_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(f"k{i}", f"d{i % 3}", i) for i in range(60)]
    frame(spark, rows).repartition(8).write.partitionBy("date").parquet(path)
    others = data_files(f"{path}/date=d0")
    before = len(data_files(f"{path}/date=d1"))
    assert tables.compact_files(spark, path, settled_minutes=0, where=F.col("folder") == "/date=d1") == before
    assert len(data_files(f"{path}/date=d1")) == 1 < before
    assert data_files(f"{path}/date=d0") == others
    assert content(spark.read.parquet(path)) == sorted((k, n) for k, _, n in rows)
    assert not os.path.exists(f"{path}_compacting")
    assert tables.compact_files(spark, path, settled_minutes=60) == 0        # too new
    assert tables.compact_files(spark, f"{path}/date=d1", settled_minutes=0) == 0


def test_compaction_never_reads_partition_values(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(f"k{i}", ["007", "7", "a b", "1e1"][i % 4], i) for i in range(40)]
    frame(spark, rows).repartition(5).write.partitionBy("date").parquet(path)
    want = texts_of(spark, path)
    assert tables.compact_files(spark, path, settled_minutes=0) > 4
    assert texts_of(spark, path) == want and len(want) == 40
    assert len(data_files(path)) == 4


def test_large_files_are_left_alone_and_groups_keep_to_the_target(spark, tmp_path):
    path = f"{tmp_path}/t"
    big = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(1).alias("n"))
    big.coalesce(1).write.parquet(path)
    (large,) = data_files(path)
    kept = os.stat(large).st_mtime_ns
    for _ in range(6):
        big.limit(2000).coalesce(1).write.mode("append").parquet(path)
    size = max(os.path.getsize(f) for f in data_files(path) if f != large)
    tables.compact_files(spark, path, target_bytes=int(size * 3), settled_minutes=0)
    assert os.stat(large).st_mtime_ns == kept
    assert len(data_files(path)) == 3                      # the large one and two of three each
    assert spark.read.parquet(path).count() == 32_000
    with_more = spark.range(3).select(F.lit("z").alias("k"), F.lit(2).alias("n"), F.lit("new").alias("extra"))
    for _ in range(2):
        with_more.coalesce(1).write.mode("append").parquet(path)             # a column added later
    tables.compact_files(spark, path, target_bytes=int(size * 3), settled_minutes=0)
    assert spark.read.option("mergeSchema", "true").parquet(path).where("extra = 'new'").count() == 6


@pytest.mark.parametrize("moment", ["staged", "between", "moved"])
def test_a_stopped_compaction_is_carried_on(spark, tmp_path, monkeypatch, moment):
    path = f"{tmp_path}/t"
    rows = [(f"k{i}", f"d{i % 2}", i) for i in range(40)]
    frame(spark, rows).repartition(4).write.partitionBy("date").parquet(path)

    def stop(*_):
        raise RuntimeError("stopped")

    if moment == "staged":
        monkeypatch.setattr(paths, "replace", stop)
    elif moment == "between":
        replaced, calls = paths.replace, []
        monkeypatch.setattr(paths, "replace", lambda *a: stop() if calls else calls.append(replaced(*a)))
    else:
        removed = paths.remove
        monkeypatch.setattr(paths, "remove", lambda s, p: stop() if p.endswith(".parquet") else removed(s, p))
    with pytest.raises(RuntimeError):
        tables.compact_files(spark, path, settled_minutes=0)
    monkeypatch.undo()
    more = [(f"m{i}", "d0", i) for i in range(10)]
    frame(spark, more).coalesce(1).write.mode("append").partitionBy("date").parquet(path)
    tables.compact_files(spark, path, settled_minutes=0, where=F.col("folder") == "/date=none")
    assert texts_of(spark, path) == sorted((k, n, d) for k, d, n in rows + more)
    tables.compact_files(spark, path, settled_minutes=0)
    assert texts_of(spark, path) == sorted((k, n, d) for k, d, n in rows + more)
    assert len(data_files(path)) == 2 and not os.path.exists(f"{path}_compacting")


def test_compaction_of_folders_per_batch(spark, tmp_path):
    """The newest batch stays, a replay of it is harmless, and a stream reads every row once."""
    path, seen = f"{tmp_path}/fan", f"{tmp_path}/seen"
    for n in range(4):
        tables.append_batch(frame(spark, [(f"a{n}", "d1", n), (f"b{n}", "d2", n)]), path, batch_id=n)
    schema = T.StructType.fromDDL("k string, n int, date string, batch long")

    def read_stream(name):
        stream = readers.table_stream(spark, path, schema).select("k", "n", "date")
        tables.append_stream(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-c", None,
                             available_now=True).awaitTermination()
        return sorted(map(tuple, spark.read.schema("k string, n int, date string").parquet(
            f"{tmp_path}/{name}").collect()))

    rows = sorted((f"{c}{n}", n, d) for n in range(4) for c, d in (("a", "d1"), ("b", "d2")))
    assert read_stream("before") == rows
    assert tables.compact_files(spark, path, settled_minutes=0) == 6
    assert len(data_files(path)) == 4
    tables.append_batch(frame(spark, [("a3", "d1", 3), ("b3", "d2", 3)]), path, batch_id=3)
    tables.append_batch(frame(spark, [("a4", "d1", 4)]), path, batch_id=4)
    rows = sorted([*rows, ("a4", 4, "d1")])
    assert texts_of(spark, path) == rows
    assert read_stream("after") == rows                    # begun after: all rows
    got = read_stream("before")                            # begun before: the new ones only
    # a replayed batch writes new files, which such a stream reads again
    assert set(got) == set(rows) and len(got) == len(rows) + 2


def test_tables_of_a_file_sink_are_refused(spark, tmp_path):
    source, path = f"{tmp_path}/in", f"{tmp_path}/t"
    frame(spark, [("a", "d1", 1)]).write.parquet(source)
    stream = spark.readStream.schema("k string, date string, n int").parquet(source)
    tables.append_stream(stream, path, f"{tmp_path}/c", available_now=True).awaitTermination()
    with pytest.raises(ValueError, match="append_batches"):
        tables.compact_files(spark, path)


def test_catalog_helpers(spark, tmp_path):
    name = "facts_for_test"
    schema = T.StructType.fromDDL("user_id string, amount double, date string")
    tables.create_table(spark, name, schema, f"{tmp_path}/t", "date")
    tables.create_table(spark, name, schema, f"{tmp_path}/t", "date")
    tables.insert_values(spark, name, {"user_id": "9'6", "amount": None, "date": "2024-01-01"})
    assert [tuple(r) for r in spark.table(name).collect()] == [("9'6", None, "2024-01-01")]
    assert tables.preview(spark.range(50)).count() == 20
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_refreshing_snapshot_reloads_after_its_time(spark):
    now, loads = [0.0], []

    def load():
        loads.append(1)
        return spark.range(len(loads))

    snap = readers.RefreshingSnapshot(load, minutes=1, clock=lambda: now[0])
    assert snap.get().count() == 1
    now[0] = 59
    assert snap.get().count() == 1
    now[0] = 60
    assert snap.get().count() == 2


def test_versioned_snapshot_follows_the_table(spark, tmp_path):
    store = tables.KeyedTable(f"{tmp_path}/t", ["k"], partition=None, schema=T.StructType.fromDDL(
        "k string, date string, n int"))
    loads = []

    def load():
        loads.append(1)
        return store.read(spark)

    snap = readers.VersionedSnapshot(load, lambda: store.version(spark))
    assert content(snap.get()) == []
    store.put(frame(spark, [("a", "d", 1)]), 0)
    assert content(snap.get()) == content(snap.get()) == [("a", 1)]
    store.put(frame(spark, [("a", "d", 2)]), 1)
    assert content(snap.get()) == [("a", 2)] and len(loads) == 3


def test_range_bounds_reach_the_files(spark, tmp_path):
    path = f"{tmp_path}/keys"
    rows = spark.range(2000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    readers.write_row_keys(rows, path, "id", 8)
    table = spark.read.parquet(path)
    scan = readers.range_scan(table, "id", "15", "16", ["id", "v"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,15), LessThan(id,16)]" in plan
    assert [r.id for r in scan.collect()] == sorted(str(i) for i in range(2000) if "15" <= str(i) < "16")
    ends = table.groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).collect()
    ranges = sorted((r[1], r[2]) for r in ends)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))              # files don't overlap


def test_scan_order_and_absent_column_pass(spark):
    df = spark.createDataFrame([("1", "x"), ("10", None), ("11", "y"), ("2", "x")], "k string, c string")
    assert [r.k for r in readers.range_scan(df, "k", "1", "2", ["k"]).collect()] == ["1", "10", "11"]
    got = readers.range_scan_filtered(df, "k", "1", "2", "c", "x", ["k"]).collect()
    assert [r.k for r in got] == ["1", "10"]
    assert readers.point_get(df, "k", "11", ["c"]).first().c == "y"


def test_rate_and_console_streams_start(spark, tmp_path):
    query = tables.console_stream(readers.ticks(spark))
    try:
        assert query.isActive
    finally:
        query.stop()


def test_broker_options():
    assert readers.kafka_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "failOnDataLoss": "false"}


@pytest.mark.parametrize("streamed", [False, True])
def test_newer_files_come_later_whatever_their_size(spark, tmp_path, streamed):
    path = str(tmp_path / "in")
    spark.createDataFrame([("a1",)], "value string").coalesce(1).write.text(path)
    newer = [(f"b{i} {'x' * 50}",) for i in range(200)]
    spark.createDataFrame(newer, "value string").coalesce(1).write.mode("append").text(path)
    if streamed:
        seen = []
        stream = readers.message_stream(spark, "text", path, ordered=True)
        tables.each_batch(stream, lambda df, n: seen.extend(with_order(df).orderBy("_order").collect()),
                   str(tmp_path / "c"), available_now=True).awaitTermination()
    else:
        seen = with_order(readers.messages(spark, path, ordered=True)).orderBy("_order").collect()
    assert [r.value for r in seen] == ["a1", *[v for v, in newer]]
