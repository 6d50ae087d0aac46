"""What the operators share: scratch tables, joins by checked size, Arrow passes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import paths

#: A side of a join is broadcast up to this many rows of a few numbers, and shuffled beyond.
BROADCAST_ROWS = 500_000
#: Rows handled at once: long texts and packed pages make rows of up to some hundred kB.
BATCH_ROWS = 256


def small(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches of a task cut to at most ``rows`` rows each, empty ones left out. How many rows
    Spark sends at once is the session's setting, which is not for this part to change. Workers
    outlive their tasks: memory kept for batches to come goes back when a task's last one is done."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    batch = None
    pa.default_memory_pool().release_unused()


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared scratch folder: cuts the lineage, and what
    was computed outlives the executors."""
    spark = df.sparkSession
    path = paths.scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_side(left: DataFrame, side: DataFrame, on: str | Sequence[str], how: str,
              rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a side of ``rows`` counted rows: broadcast up to ``limit``, shuffled beyond."""
    return left.join(F.broadcast(side) if rows <= limit else side, on, how)


def arrow_pass(df: DataFrame, schema: str,
               each: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None]
               ) -> DataFrame:
    """Map small Arrow batches one by one; ``each`` gives a batch, or none."""
    def run(batches):
        for batch in small(batches):
            made = each(batch)
            if made is not None and made.num_rows:
                yield made
    return df.mapInArrow(run, schema)


def rows_of(batches: Iterable[pa.RecordBatch], columns: Iterable[str], rows: int = BATCH_ROWS
            ) -> Iterator[tuple]:
    """The rows of a task as tuples of the given columns, a few at a time."""
    names = list(columns)
    for batch in small(batches, rows):
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def beside(first: DataFrame, then: DataFrame, partitions: int, keys: list[str]) -> DataFrame:
    """Rows of both by key, one key after the other, each key's row of ``first`` before those of
    ``then``: what is large is met once per key, and the rest streams by."""
    both = first.withColumn("kind", F.lit(0)).unionByName(then.withColumn("kind", F.lit(1)),
                                                          allowMissingColumns=True)
    return both.repartition(partitions, *keys).sortWithinPartitions(*keys, "kind")


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id (as long) and the text; other columns, whatever their names, stay out."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).cast("string").alias("text"))


def new_name(prefix: str, taken: Sequence[str]) -> str:
    """A column name that no column of a caller's table has."""
    name = f"__{prefix}"
    while name.lower() in {t.lower() for t in taken}:
        name = f"__{prefix}_{uuid.uuid4().hex[:8]}"
    return name
