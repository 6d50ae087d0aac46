"""Daily-first rules on micro-batches, with each key's last day kept in a table.

The form for busy streams: everything runs in the JVM, the day of a key's last visit lies in a
bucketed keyed table instead of a state store, and a micro-batch reads the buckets of its own keys
only. What a batch adds to the metrics is written as increments, summed per key and second, and a
second stream puts windows over these.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.visits import DAY, PREVIOUS, first_of_day
from ..operators.windows import union_flagged
from ..sources import tables


def visit_store(path: str, keys: dict[str, T.DataType], buckets: int = 16) -> tables.KeyedTable:
    """The table that holds the day of each key's last visit."""
    fields = [T.StructField(k, kind) for k, kind in keys.items()]
    return tables.KeyedTable(path, list(keys), partition=None, buckets=buckets, schema=T.StructType([
        *fields, T.StructField(DAY, T.DateType())]))


def first_of_day_batch(batch: DataFrame, batch_id: int, store: tables.KeyedTable, ts: str,
                       keep: Sequence[str] = ()) -> DataFrame:
    """``first_of_day`` of one micro-batch, going on from the days the store holds.

    Call it inside ``foreachBatch`` on a cached batch. Days are read as they were before
    the batch, so a replay gives the same rows; the batch's own are written before the
    rows are returned. A day other than the key's last one counts, as in the state processor.
    """
    keys = store.keys
    rows = batch.where(F.col(ts).isNotNull()).na.drop(subset=keys)
    store.compact_every(batch.sparkSession, batch_id)
    last = store.read_for(rows, keys, before=batch_id).withColumnRenamed(DAY, "_last")
    first = first_of_day(rows, keys, ts, list(keep)).join(last, keys, "left")
    order = Window.partitionBy(*keys).orderBy(DAY)
    before = F.when(F.row_number().over(order) == 1, F.col("_last")).otherwise(F.col(PREVIOUS))
    flagged = (first.withColumn(PREVIOUS, before).drop("_last")
               .where(F.col(PREVIOUS).isNull() | (F.col(PREVIOUS) != F.col(DAY))))
    if not rows.isEmpty():
        store.put(rows.groupBy(*keys).agg(F.max(F.to_date(ts)).alias(DAY)), batch_id)
    return flagged


def beat(batch: DataFrame, ts: str) -> DataFrame:
    """One row with the newest time of the batch and no counts: windows close by it even when
    a batch has nothing to count."""
    return batch.agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())


def increments(parts: Sequence[DataFrame], keys: Sequence[str], ts: str) -> DataFrame:
    """Rows of counts summed per key and second; windows with bounds at whole seconds come out
    the same from them."""
    both = union_flagged(*parts)
    counts = [c for c in both.columns if c not in (*keys, ts)]
    second = F.date_trunc("second", ts).alias(ts)
    return both.groupBy(*keys, second).agg(*[F.sum(c).alias(c) for c in counts])


def increments_stream(df: DataFrame, step: Callable[[DataFrame, int], DataFrame], path: str,
                      checkpoint: str, available_now: bool = False, trigger: str | None = None
                      ) -> StreamingQuery:
    """Write what ``step`` makes of each micro-batch, in a folder per batch.

    A batch is one file: were it several, the stream that reads them could take one of them first
    and find the others' rows behind its watermark. As increments have one row per key and second,
    a file does not grow with the rows of the stream.
    """
    def write(batch: DataFrame, n: int) -> None:
        with tables.cached(batch) as rows, tables.cached(step(rows, n).repartition(1)) as made:
            tables.append_batch(made, path, None, batch_id=n)
    return tables.each_batch(df, write, checkpoint, available_now, trigger)
