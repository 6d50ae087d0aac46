"""Rows behind the watermark: told apart and kept, where Spark's own operators drop them.

A stream's newest time is kept per micro-batch in a small table, so which rows of a batch are late
does not hang on how often the batch is run. Late means more than the delay behind the newest time
of all earlier batches: where a window's watermark stands as the batch begins. (Spark's windows drop
a row of a closed window; they go by the watermark of the batch before, one batch later.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import tables

_STREAM, _HIGH = "stream", "high"


def high_marks(path: str) -> tables.KeyedTable:
    """The table of newest times, one row per stream."""
    return tables.KeyedTable(path, [_STREAM], partition=None, schema=T.StructType([
        T.StructField(_STREAM, T.StringType()), T.StructField(_HIGH, T.TimestampType())]))


def with_late(batch: DataFrame, batch_id: int, marks: tables.KeyedTable, ts: str, delay: str,
              stream: str = "all") -> DataFrame:
    """The batch with ``late`` (true or false; rows without a time are late).

    Call it inside ``foreachBatch`` on a cached batch; the batch's own newest time is
    stored for the batches after it.
    """
    spark = batch.sparkSession
    marks.compact_every(spark, batch_id)
    stored = marks.read(spark, F.col(_STREAM) == stream, before=batch_id)
    known = [r[0] for r in stored.select(F.unix_micros(_HIGH)).collect()]      # one row at most
    own = batch.agg(F.unix_micros(F.max(ts))).first()[0]
    newest = max([m for m in (*known, own) if m is not None], default=None)
    if newest is not None:
        marks.put(spark.createDataFrame([(stream, newest)], f"{_STREAM} string, _at long").select(
            _STREAM, F.timestamp_micros("_at").alias(_HIGH)), batch_id)
    if not known:
        return batch.withColumn("late", F.col(ts).isNull())
    mark = F.timestamp_micros(F.lit(known[0])) - F.expr(f"INTERVAL {delay}")
    return batch.withColumn("late", F.coalesce(F.col(ts) <= mark, F.lit(True)))
