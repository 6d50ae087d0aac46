"""Message streams, table streams, snapshots and keyed reads."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    """Options of the message broker connector: one topic, tolerant of lost data."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": "false"}


def file_order() -> Column:
    """Place of a row's part of a file: older files first.

    Scans pack large files first, so the row numbers of a scan alone don't follow file age;
    inside a part they do (streams can't number rows, their micro-batches can).
    """
    return F.struct("_metadata.file_modification_time", "_metadata.file_path",
                    "_metadata.file_block_start")


def message_stream(spark: SparkSession, fmt: str, path: str | None = None,
                   options: Mapping[str, str] | None = None, ordered: bool = False) -> DataFrame:
    """Messages as ``key`` and ``value`` texts.

    ``kafka`` takes its options from ``kafka_options``; ``text`` reads one message per
    line with a null key; file formats with both columns are read with that schema.
    ``ordered`` adds ``_order``: a broker message's offset (the messages of one key share a
    topic partition, so it orders them), or a file row's ``file_order``.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if fmt not in ("text", "kafka"):
        reader = reader.schema(MESSAGE)
    return _as_messages(reader.load(path) if path else reader.load(), fmt, ordered)


def _as_messages(loaded: DataFrame, fmt: str, ordered: bool) -> DataFrame:
    key = F.lit(None) if fmt == "text" else F.col("key")
    order = [(F.col("offset") if fmt == "kafka" else file_order()).alias("_order")]
    return loaded.select(key.cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                         *(order if ordered else []))


def messages(spark: SparkSession, path: str, fmt: str = "text", ordered: bool = False) -> DataFrame:
    """The same messages as a batch."""
    reader = spark.read.format(fmt)
    if fmt != "text":
        reader = reader.schema(MESSAGE)
    return _as_messages(reader.load(path), fmt, ordered)


def table_stream(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
                 max_files: int | None = 5, max_bytes: int | None = None,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """An append-only table as a stream, limited per micro-batch by files or by bytes.

    File sources take one of the two limits (``max_bytes`` wins); the table format
    with a change log takes both and skips update and delete commits. Without ``schema``
    the stream has all columns that files have as it starts, older files with nulls in
    columns that were added later.
    """
    if schema is None and fmt != "delta":
        schema = snapshot(spark, path, fmt, merge_schema=True).schema
    reader = spark.readStream.format(fmt)
    if fmt == "delta":
        reader = reader.option("skipChangeCommits", "true")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
    else:
        reader = reader.schema(schema)
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        elif max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**dict(options or {})).load(path)


def snapshot(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False
             ) -> DataFrame:
    """The table as it is now; ``merge_schema`` reads files written before a column was added."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a batch frame out evenly for costly work per row, over ``partitions`` (the session's
    number of shuffle partitions, if not given); streams stay as they are."""
    if df.isStreaming:
        return df
    return df.repartition(partitions or int(
        df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class RefreshingSnapshot:
    """A cached snapshot re-read when it is older than ``minutes``.

    Ask for it inside ``foreachBatch``: each micro-batch then sees a frame that is
    at most that old.
    """

    def __init__(self, load: Callable[[], DataFrame], minutes: float,
                 clock: Callable[[], float] = time.monotonic):
        self._load, self._seconds, self._clock = load, minutes * 60, clock
        self._frame: DataFrame | None = None
        self._read_at = 0.0

    def get(self) -> DataFrame:
        if self._frame is None or self._clock() - self._read_at >= self._seconds:
            stale, self._frame = self._frame, self._load().persist()
            self._read_at = self._clock()
            if stale is not None:
                stale.unpersist()
        return self._frame


class VersionedSnapshot:
    """A cached frame of a stored table, loaded anew when the table's version changes.

    Ask for it inside ``foreachBatch``: a change shows in the next micro-batch, and a table
    that stays as it is is read once, however long the stream runs.
    """

    def __init__(self, load: Callable[[], DataFrame], version: Callable[[], object]):
        self._load, self._version = load, version
        self._frame: DataFrame | None = None
        self._seen: object = None

    def get(self) -> DataFrame:
        now = self._version()
        if self._frame is None or now != self._seen:
            stale, self._frame = self._frame, self._load().persist()
            self._seen = now
            if stale is not None:
                stale.unpersist()
        return self._frame


def ticks(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A rate stream, used as a timer."""
    return (spark.readStream.format("rate").option("rowsPerSecond", per_second)
            .option("numPartitions", 1).load())


def row_key(table: DataFrame, column: str) -> Column:
    """Row keys are texts and compare as texts; a key stored as text stays as it is, so that
    conditions on it reach the files."""
    kind = table.schema[column].dataType
    return F.col(column) if isinstance(kind, T.StringType) else F.col(column).cast("string")


def write_row_keys(df: DataFrame, path: str, key: str, partitions: int | None = None) -> None:
    """Store rows in the order of a text key: each file holds a range of keys, sorted, so a scan
    of a range opens few files and, in these, few row groups."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.withColumn(key, F.col(key).cast("string")).repartitionByRange(n, key)
     .sortWithinPartitions(key).write.mode("overwrite").parquet(path))


def point_get(table: DataFrame, key: str, value: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of one row."""
    return table.where(F.col(key) == F.lit(value).cast(table.schema[key].dataType)).select(*columns)


def range_scan(table: DataFrame, key: str, start: str, stop: str, columns: Sequence[str]
               ) -> DataFrame:
    """Rows with ``start <= key < stop`` in text order, sorted by key."""
    text = row_key(table, key)
    return table.where((text >= start) & (text < stop)).orderBy(text).select(*columns)


def range_scan_filtered(table: DataFrame, key: str, start: str, stop: str, column: str,
                        value: str, columns: Sequence[str]) -> DataFrame:
    """``range_scan`` keeping rows whose column has the value or is absent (null)."""
    matches = (F.col(column).cast("string") == value) | F.col(column).isNull()
    return range_scan(table.where(matches), key, start, stop, columns)
