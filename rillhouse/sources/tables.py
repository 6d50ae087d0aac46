"""Writing tables: appends, fan-out, keyed replace tables, merged versions, upkeep."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import latest_per_key
from ..operators.merge import STRICT, Policy, apply_folded, fold_changes, typed_as
from . import paths


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def checkpoint_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/checkpoints/{layer}/{table}"


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Hold a frame used by several jobs and release it afterwards."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def by_partition(df: DataFrame, column: str) -> DataFrame:
    """Bring rows of one table partition together before a partitioned write.

    Without it every task writes a file for every date it holds. The rebalance is
    adaptive: small partitions share a task and a large one is split by size, so a
    date with most of the rows is still written by many tasks.
    """
    return df.hint("rebalance", F.col(column))


# --- appends -----------------------------------------------------------------------------

def append_stream(df: DataFrame, path: str, checkpoint: str, date: str | None = "date",
                  fmt: str = "parquet", available_now: bool = False,
                  trigger: str | None = None) -> StreamingQuery:
    """Continuous append, partitioned by the date column."""
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", path))
    if date:
        writer = writer.partitionBy(date)
    return _triggered(writer, available_now, trigger).start()


def append_batches(df: DataFrame, path: str, checkpoint: str, date: str | None = "date",
                   available_now: bool = False, trigger: str | None = None) -> StreamingQuery:
    """Continuous append like ``append_stream``, each micro-batch in its own folder.

    A replayed micro-batch replaces its folder, and no log names the files, so the table can be
    compacted (``compact_files``). The column ``batch`` is the folder's number.
    """
    def write(batch: DataFrame, n: int) -> None:
        with cached(batch) as rows:
            append_batch(rows, path, date, batch_id=n)
    return each_batch(df, write, checkpoint, available_now, trigger)


def _triggered(writer, available_now: bool, trigger: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def append_batch(df: DataFrame, path: str, date: str | None = "date", mode: str = "append",
                 fmt: str = "parquet", evolve: bool = False, batch_id: int | None = None) -> bool:
    """Write a batch, partitioned by date if given; an empty one writes nothing (returns False).

    With ``batch_id`` the rows go to the batch's own folder, replaced as a whole when
    the batch is run again, so a replay after a failure adds no row twice.
    ``evolve`` merges new columns into formats that keep a table schema; plain files
    are merged on the read side (``snapshot(..., merge_schema=True)``).
    """
    if df.isEmpty():
        return False
    writer = by_partition(df, date).write.partitionBy(date) if date else df.write
    writer = writer.format(fmt)
    if evolve:
        writer = writer.option("mergeSchema", "true")
    if batch_id is None:
        writer.mode(mode).save(path)
    else:
        (writer.mode("overwrite").option("partitionOverwriteMode", "static")
         .save(f"{path}/batch={batch_id}"))
    return True


def console_stream(df: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    writer = df.writeStream.format("console")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], object], checkpoint: str,
               available_now: bool = False, trigger: str | None = None) -> StreamingQuery:
    """Run ``fn`` on every micro-batch."""
    writer = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, trigger).start()


Sink = Callable[[DataFrame, int], object]


def route(batch: DataFrame, batch_id: int,
          routes: Mapping[str, tuple[Callable[[DataFrame], DataFrame], Sink]]) -> None:
    """Send one micro-batch to several sinks in turn, computing it once."""
    with cached(batch):
        for select, sink in routes.values():
            sink(select(batch), batch_id)


# --- keyed replace tables ------------------------------------------------------------------

_BATCH, _GONE, _BUCKET, _MARK = "_batch", "_gone", "_bucket", "_mark"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; keys must have the type they are stored with."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class KeyedTable:
    """Table in which a newer row replaces the older one with the same key.

    A batch is written to its own folder and nothing is read or rewritten, so the
    cost of a write is the cost of the batch and a replayed batch overwrites itself.
    Reading keeps the newest row per key by aggregation; filters on key columns
    reach the files. ``compact`` folds batch folders together from time to time;
    what a fold covers is removed ``keep_hours`` later, so frames read before it still
    find their files.

    With ``buckets`` (instead of a partition column) rows are stored by a hash of the key
    and sorted by key in their files, so a read of a few keys opens their buckets only.
    Give ``schema`` where columns may be added over time; otherwise it is taken from
    the stored files.
    """

    def __init__(self, path: str, keys: Sequence[str], partition: str | None = "date",
                 schema: T.StructType | None = None, buckets: int | None = None,
                 keep_hours: float = 24):
        if buckets and partition:
            raise ValueError("a keyed table has a partition column or buckets, not both")
        self.path, self.keys, self.partition = path.rstrip("/"), list(keys), partition
        self.schema, self.buckets, self.keep_hours = schema, buckets, keep_hours

    def _parts(self, spark: SparkSession) -> dict[str, float]:
        """Labels of the committed folders (b = one batch, c = folded batches, f = folded table;
        then the newest batch in it), and when each was committed."""
        return {name.partition("=")[2]: at for name, at in paths.completed(spark, self.path).items()
                if name.startswith("part=")}

    def _write(self, df: DataFrame, folder: str) -> None:
        part = self.partition
        if self.buckets:
            part = _BUCKET
            df = df.withColumn(_BUCKET, bucket_of(self.keys, self.buckets))
        if part:
            df = by_partition(df, part)
        if self.buckets:
            df = df.sortWithinPartitions(_BUCKET, *self.keys)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if part:
            writer = writer.partitionBy(part)
        writer.parquet(folder)

    def put(self, batch: DataFrame, batch_id: int, order_by: Sequence[str] = (),
            gone: str | None = None) -> None:
        """Write a batch of new values; rows whose ``gone`` column is true remove their key.

        ``order_by`` picks the newest of several rows with one key inside the batch.
        """
        newest = self.version(batch.sparkSession)
        if newest > batch_id:
            raise ValueError(f"{self.path} already holds batch {newest}; batch {batch_id} would be "
                             "hidden by it (was the checkpoint lost?)")
        if order_by:
            batch = latest_per_key(batch, self.keys, order_by)
        flag = F.col(gone) if gone else F.lit(False)
        marked = batch.withColumns({_BATCH: F.lit(batch_id).cast("long"), _GONE: flag})
        self._write(marked.drop(gone) if gone else marked, f"{self.path}/part=b{batch_id:012d}")

    def version(self, spark: SparkSession) -> int:
        """The newest batch stored; -1 for none."""
        return max((int(label[1:]) for label in self._parts(spark)), default=-1)

    def _live(self, spark: SparkSession, before: int | None = None) -> list[tuple[str, int]]:
        """Folders that hold what is stored, those that a later fold covers left out."""
        done = [(label, int(label[1:])) for label in sorted(self._parts(spark))
                if before is None or int(label[1:]) < before]
        whole = max((at for label, at in done if label[0] == "f"), default=-1)
        folded = max((at for label, at in done if label[0] in "cf"), default=-1)
        return [(label, at) for label, at in done
                if at > {"f": whole - 1, "c": whole, "b": folded}[label[0]]]

    def _load(self, spark: SparkSession, labels: Sequence[str]) -> DataFrame:
        done = [f"{self.path}/part={n}" for n in labels]
        full = None if self.schema is None else T.StructType([
            *self.schema.fields, T.StructField(_BATCH, T.LongType()),
            T.StructField(_GONE, T.BooleanType()),
            *([T.StructField(_BUCKET, T.IntegerType())] if self.buckets else [])])
        if not done:
            if full is None:
                raise FileNotFoundError(f"{self.path} holds no batch yet")
            return spark.createDataFrame([], full)
        reader = spark.read.option("basePath", self.path)
        return (reader if full is None else reader.schema(full)).parquet(*done).drop("part")

    def stored(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All stored rows (of batches ``before`` one) with their batch, replaced ones included."""
        return self._load(spark, [label for label, _ in self._live(spark, before)])

    def _current(self, rows: DataFrame) -> DataFrame:
        newest = latest_per_key(rows.drop(_BUCKET), self.keys, [_BATCH])
        return newest.where(~F.col(_GONE)).drop(_BATCH, _GONE)

    def read(self, spark: SparkSession, where: Column | None = None, before: int | None = None
             ) -> DataFrame:
        """Current rows (as of ``before`` a batch); ``where`` is a condition on key columns, applied
        while reading."""
        rows = self.stored(spark, before)
        return self._current(rows if where is None else rows.where(where))

    def read_for(self, wanted: DataFrame, on: str | Sequence[str], before: int | None = None
                 ) -> DataFrame:
        """Current rows (as of ``before`` a batch) of the keys in the columns ``on`` of ``wanted``.

        The other rows are dropped before the newest is sought, so what is shuffled
        grows with the asked-for keys, not with the table. With buckets, one job over
        ``wanted`` (hold it if it is costly) finds which of them the keys lie in, and the range
        of the first key: other buckets are not opened, and in a file other row groups are skipped.
        """
        rows = self.stored(wanted.sparkSession, before)
        named = zip([on] if isinstance(on, str) else on, self.keys, strict=True)
        asked = wanted.select(*[F.col(o).cast(rows.schema[k].dataType).alias(k) for o, k in named])
        asked = asked.na.drop().distinct()
        if self.buckets:
            # One number per bucket at most comes to the driver.
            first = self.keys[0]
            there = asked.agg(F.collect_set(bucket_of(self.keys, self.buckets)).alias("buckets"),
                              F.min(first).alias("low"), F.max(first).alias("high")).first()
            rows = rows.where(F.col(_BUCKET).isin(there.buckets)
                              & F.col(first).between(F.lit(there.low), F.lit(there.high)))
        return self._current(rows.join(asked, self.keys, "left_semi"))

    def compact_every(self, spark: SparkSession, batch_id: int, batches: int = 100) -> None:
        """Fold once this many batches are stored singly; call it as a batch begins.

        Batches are counted as stored, so empty ones, which store nothing, don't matter. Folds
        are folded into one when there are as many of them.
        """
        labels = [label for label, _ in self._live(spark, batch_id)]
        if sum(label[0] == "b" for label in labels) >= batches:
            self.compact(spark, before=batch_id,
                         full=sum(label[0] == "c" for label in labels) >= batches)

    def compact(self, spark: SparkSession, full: bool = False, before: int | None = None) -> None:
        """Fold the single batches into one folder (``full``: everything stored so far).

        Rows keep their batch number, so while old and new folders stand side by side
        a read gives the same rows; a stop at any point leaves a correct table.
        """
        parts = [(label, at) for label, at in self._live(spark, before) if full or label[0] == "b"]
        if len(parts) > 1:
            newest = max(at for _, at in parts)
            # Straight to its place: its commit mark is what makes it count, and what a stopped
            # fold left there is overwritten.
            rows = self._load(spark, [name for name, _ in parts]).drop(_BUCKET)
            self._write(latest_per_key(rows, self.keys, [_BATCH]),
                        f"{self.path}/part={'f' if full else 'c'}{newest:012d}")
        self._sweep(spark)

    def _sweep(self, spark: SparkSession) -> None:
        """Remove folders that a fold has covered for ``keep_hours``."""
        parts, live = self._parts(spark), {label for label, _ in self._live(spark)}
        for label in parts.keys() - live:
            covered = min(at for other, at in parts.items() if other != label
                          and other[0] in "cf" and int(other[1:]) >= int(label[1:]))
            if time.time() - covered >= self.keep_hours * 3600:
                paths.remove(spark, f"{self.path}/part={label}")


def metric_stream(df: DataFrame, table: KeyedTable, checkpoint: str, available_now: bool = False
                  ) -> StreamingQuery:
    """Stream of metric rows into a keyed replace table."""
    return each_batch(df, lambda batch, n: table.put(batch, n), checkpoint, available_now)


# --- merged tables -------------------------------------------------------------------------

class MergedTable:
    """Table kept by change merges, stored by a hash of the key.

    A merge reads and writes only the buckets that hold a changed key: their new content goes to
    the batch's own version folder, and readers take the newest complete version of each bucket.
    Nothing is written in place, so a stopped or repeated merge never harms the table. What newer
    versions cover is removed ``keep_hours`` later, so frames read before still find their files.
    """

    def __init__(self, path: str, schema: T.StructType, partition_by: str | None = None,
                 buckets: int = 16, keep_hours: float = 24):
        self.path, self.schema = path.rstrip("/"), schema
        self.partition_by, self.buckets, self.keep_hours = partition_by, buckets, keep_hours

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version:012d}"

    def _versions(self, spark: SparkSession) -> dict[int, float]:
        """Complete versions, and when each was committed."""
        return {int(n[2:]): at for n, at in paths.completed(spark, self.path).items()
                if n.startswith("v=")}

    def _holding(self, spark: SparkSession, done: Collection[int]) -> dict[int, list[int]]:
        """Versions that hold each bucket, oldest first."""
        found: dict[int, list[int]] = {}
        for folder, inner in paths.grandchildren(spark, self.path, f"{_BUCKET}="):
            version = int(folder[2:])
            if version in done:
                found.setdefault(int(inner.partition("=")[2]), []).append(version)
        return found

    def _load(self, spark: SparkSession, newest: Mapping[int, int]) -> DataFrame:
        """Rows of the given buckets, each in the given version."""
        known = {f.name: f.dataType for f in self.schema.fields}
        whole = spark.createDataFrame([], self.schema)
        for version in sorted(set(newest.values())):
            folder = self._folder(version)
            at = [f"{folder}/{_BUCKET}={b}" for b, v in sorted(newest.items()) if v == version]
            stored = spark.read.option("basePath", folder).parquet(at[0]).schema
            # Read with the declared type, so a partition value is not guessed from its folder name.
            typed = T.StructType([
                T.StructField(f.name, known[f.name] if f.name == self.partition_by and f.name in known
                              else f.dataType) for f in stored.fields])
            held = spark.read.schema(typed).option("basePath", folder).parquet(*at)
            held = held.where(~F.col(_MARK)).drop(_MARK, _BUCKET)
            held = held.select(*[F.col(c).cast(known[c]) if c in known else F.col(c)
                                 for c in held.columns])
            whole = whole.unionByName(held, allowMissingColumns=True)
        return whole

    def create_if_absent(self, spark: SparkSession) -> None:
        if not self._versions(spark):
            self._save(spark.createDataFrame([], self.schema), 0, [], self.schema.fieldNames()[0])

    def version(self, spark: SparkSession) -> int:
        """The newest version stored; -1 for none."""
        return max(self._versions(spark), default=-1)

    def read(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """Current rows; ``where`` reaches the files."""
        holding = self._holding(spark, self._versions(spark))
        rows = self._load(spark, {b: v[-1] for b, v in holding.items()})
        return rows if where is None else rows.where(where)

    def read_for(self, wanted: DataFrame, on: str, key: str) -> DataFrame:
        """Current rows of the keys in column ``on`` of ``wanted``; other buckets are not opened."""
        spark = wanted.sparkSession
        asked = (wanted.select(F.col(on).cast(self.schema[key].dataType).alias(key))
                 .where(F.col(key).isNotNull()).distinct())
        there = {r[0] for r in asked.select(bucket_of([key], self.buckets)).distinct().collect()}
        holding = self._holding(spark, self._versions(spark))
        rows = self._load(spark, {b: v[-1] for b, v in holding.items() if b in there})
        return rows.join(asked, key, "left_semi")

    def _save(self, rows: DataFrame, version: int, touched: Sequence[int], key: str) -> None:
        """Write a version; a marker row per touched bucket lets one without rows hide older ones."""
        marks = rows.sparkSession.createDataFrame([(b,) for b in touched], f"{_BUCKET} int").withColumn(
            _MARK, F.lit(True))
        df = (rows.withColumns({_BUCKET: bucket_of([key], self.buckets), _MARK: F.lit(False)})
              .unionByName(marks, allowMissingColumns=True))
        by = [_BUCKET, *([self.partition_by] if self.partition_by else [])]
        (by_partition(df, _BUCKET).sortWithinPartitions(*by, key).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(*by).parquet(self._folder(version)))

    def merge(self, changes: DataFrame, batch_id: int, key: str, order_by: Sequence[str],
              op: str = "type", policy: Policy | None = None) -> None:
        """Apply the changes of one micro-batch; running it again gives the same table."""
        spark = changes.sparkSession
        version = batch_id + 1   # version 0 is the empty table
        versions = self._versions(spark)
        if versions and max(versions) > version:
            raise ValueError(f"{self.path} already holds version {max(versions)}; batch {batch_id} "
                             "is older (was the checkpoint lost?)")
        holding = self._holding(spark, {v for v in versions if v < version})
        newest = {b: v[-1] for b, v in holding.items()}
        base = self._load(spark, newest)
        absent = {c: F.lit(None).cast(base.schema[c].dataType)
                  for c in base.columns if c not in changes.columns}
        changes = typed_as(base, changes.withColumns(absent)).where(F.col(key).isNotNull())
        folded = fold_changes(changes, key, order_by, op, policy or STRICT, base.columns)
        with cached(folded) as once:
            # One number per bucket at most comes to the driver.
            touched = [r[0] for r in once.select(bucket_of([key], self.buckets)).distinct().collect()]
            if touched:
                mine = self._load(spark, {b: v for b, v in newest.items() if b in touched})
                mine = mine.select(*mine.columns, *[F.lit(None).cast(base.schema[c].dataType).alias(c)
                                                    for c in base.columns if c not in mine.columns])
                self._save(apply_folded(mine.select(*base.columns), once, key), version, touched, key)
        self._sweep(spark)

    def _sweep(self, spark: SparkSession) -> None:
        """Remove versions of which newer ones have covered every bucket for ``keep_hours``."""
        versions = self._versions(spark)
        covered: dict[int, float] = dict.fromkeys(versions, 0.0)
        for held in self._holding(spark, versions).values():
            for old, new in zip(held, [*held[1:], None]):
                covered[old] = max(covered[old], float("inf") if new is None else versions[new])
        for version, at in covered.items():
            if version != max(versions) and time.time() - at >= self.keep_hours * 3600:
                paths.remove(spark, self._folder(version))


# --- catalog and upkeep --------------------------------------------------------------------

def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition_by: str | None = None, fmt: str = "parquet") -> None:
    """Register a table at a location unless it is there already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                        + ("" if f.nullable else " NOT NULL") for f in schema.fields)
    part = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{part} "
              f"LOCATION '{location}'")


def insert_values(spark: SparkSession, table: str, row: Mapping[str, object]) -> None:
    """``INSERT INTO table (columns) VALUES (…)`` with bound parameters."""
    columns = ", ".join(f"`{c}`" for c in row)
    marks = ", ".join(f":v{i}" for i in range(len(row)))
    spark.sql(f"INSERT INTO {table} ({columns}) VALUES ({marks})",
              args={f"v{i}": v for i, v in enumerate(row.values())})


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows of a table (a look at it, not a result)."""
    return df.limit(rows)


#: Names of the folders a compaction stages its work in, beside the table.
_COMPACTING = "_compacting"


def small_files(spark: SparkSession, path: str, smaller_than: int, settled_minutes: float,
                where: Column | None = None) -> DataFrame:
    """folder, file, size of a table's files that are small and were written a while ago.

    Sizes and times are the scan's own metadata, so larger files are not opened. ``folder`` is the
    partition a file lies in, the folder of its micro-batch left out; ``where`` may name it.
    Files of the newest micro-batch, which a replay would overwrite, are never among them.
    """
    at = F.col("_metadata.file_path")
    batch = F.regexp_extract(at, r"/batch=(\d+)/", 1)
    newest = max((int(n[6:]) for n in paths.children(spark, path) if n.startswith("batch=")), default=-1)
    settled = F.col("_metadata.file_modification_time") <= F.current_timestamp() - F.make_interval(
        secs=F.lit(settled_minutes * 60))
    folder = F.regexp_extract(F.regexp_replace(at, r"/batch=\d+/", "/"), r"((?:/[^/=]+=[^/]*)*)/[^/]+$", 1)
    found = (spark.read.option("recursiveFileLookup", "true").parquet(path)
             .where((F.col("_metadata.file_size") < smaller_than) & settled
                    & ((batch == "") | (batch.try_cast("long") < newest)))
             .select(folder.alias("folder"), at.alias("file"), F.col("_metadata.file_size").alias("size"))
             .distinct())
    return found if where is None else found.where(where)


def compact_files(spark: SparkSession, path: str, target_bytes: int = 128 << 20,
                  settled_minutes: float = 60, where: Column | None = None) -> int:
    """Join the small files of an append table, partition by partition, into files of about
    ``target_bytes``; returns how many files went into larger ones.

    It serves tables written by batches (``append_batch``) and by streams that write a folder per
    micro-batch (``append_batches``, fan-out), with or without partitions. Files of half the
    target and more are left alone. Partition values are never read, only the folders kept.
    ``where`` chooses partitions by the column ``folder``, such as ``/date=2024-01-01``.

    Joined rows are first written to a folder beside the table. Then each joined file takes the
    place and name of the first of those it stands for, in one step, and the others are removed.
    So a stream that has read the table sees no new file, and one that starts later reads every
    row once; streams must be past files of ``settled_minutes``. A call that was stopped is carried
    on by the next: what was staged and not yet moved is moved first, rows appended in between are
    not touched; until then rows of a file that was moved but whose others were not yet removed are
    there twice, never missing. A batch read that runs at the same time may meet removed files and is
    to be repeated.
    """
    if paths.exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by a file sink, whose log names its files; write it by "
                         "append_batches to compact it")
    staged = f"{path.rstrip('/')}{_COMPACTING}"
    if paths.is_complete(spark, f"{staged}/rows"):
        _publish(spark, staged)
    paths.remove(spark, f"{staged}/rows")
    paths.remove(spark, staged)
    # Files are put into groups along a running sum of sizes; a group of one is left as it is.
    along = Window.partitionBy("folder").orderBy("file")
    placed = (small_files(spark, path, target_bytes // 2, settled_minutes, where)
              .withColumn("nth", F.floor((F.sum("size").over(along) - F.col("size")) / target_bytes)))
    group = Window.partitionBy("folder", "nth")
    (placed.withColumns({"files": F.count(F.lit(1)).over(group), "target": F.min("file").over(group)})
     .where("files > 1").withColumn("_joined", F.sha2("target", 256))
     .select("_joined", "target", "file").write.parquet(f"{staged}/plan"))
    plan = spark.read.parquet(f"{staged}/plan")
    n = plan.count()
    if n:
        rows = (spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path)
                .where(F.col("_metadata.file_size") < target_bytes // 2))
        (rows.withColumn("_file", F.col("_metadata.file_path"))
         .join(plan.select(F.col("file").alias("_file"), "_joined"), "_file").drop("_file")
         .repartition(max(1, min(plan.select("_joined").distinct().count(), 10_000)), "_joined")
         .sortWithinPartitions("_joined").write.partitionBy("_joined").parquet(f"{staged}/rows"))
        _publish(spark, staged)
    paths.remove(spark, f"{staged}/rows")   # before the plan that it needs
    paths.remove(spark, staged)
    return n


def _publish(spark: SparkSession, staged: str) -> None:
    """Move joined files to their places and remove the files they stand for; may be repeated."""
    plan = spark.read.parquet(f"{staged}/plan")
    for row in plan.where("file = target").toLocalIterator():
        folder = f"{staged}/rows/_joined={row._joined}"
        made = [name for name in paths.files(spark, folder) if name.endswith(".parquet")]
        if made:   # one task wrote a group's rows, so one file
            if len(made) != 1:
                raise RuntimeError(f"{folder} holds {len(made)} files")
            paths.replace(spark, f"{folder}/{made[0]}", paths.from_uri(spark, row.target))
    for row in plan.where("file <> target").toLocalIterator():
        paths.remove(spark, paths.from_uri(spark, row.file))
