"""Running streams to the end of the available data."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import configure
from ..sources import paths, tables


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Start queries with a chosen state width (the session's, if none is given).

    A stream keeps the number of shuffle partitions it was first started with, and
    each is a state store: choose it for the cluster the stream will grow into.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if partitions:
        spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def state_width(spark: SparkSession) -> int:
    """Two state stores per core of the cluster, or the session's shuffle partitions if they are fewer.

    A store is opened and committed in every micro-batch, whatever it holds, and keeps its rows on
    disk: more rows need no more stores.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")),
               2 * spark.sparkContext.defaultParallelism)


def drain(df: DataFrame, path: str, checkpoint: str, date: str | None = None) -> DataFrame:
    """Append everything available to ``path`` and read the table back."""
    spark = configure(df.sparkSession)
    with state_partitions(spark, state_width(spark)):
        query = tables.append_stream(df, path, checkpoint, date, available_now=True)
        query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def drain_to_scratch(df: DataFrame, label: str) -> DataFrame:
    """``drain`` into a new folder of the shared scratch area."""
    folder = paths.scratch(df.sparkSession, label)
    return drain(df, f"{folder}/table", f"{folder}/checkpoint")


def await_any(spark: SparkSession) -> None:
    """Block until one of the running streams stops."""
    spark.streams.awaitAnyTermination()


def observed_totals(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sums of the metrics a stream's ``observe(name, …)`` gathered, over its progress reports
    (Spark keeps the newest hundred; sum them as they come for a stream that runs on)."""
    totals: dict[str, int] = {}
    for report in query.recentProgress:
        row = (report.observedMetrics or {}).get(name)
        for metric, value in (row.asDict() if row is not None else {}).items():
            totals[metric] = totals.get(metric, 0) + (value or 0)
    return totals


def state_rows(spark: SparkSession, checkpoint: str, operator: str, variable: str | None = None
               ) -> DataFrame:
    """What a stopped stream holds as state, as a table of ``key`` and ``value``.

    ``operator`` is the beginning of the stateful operator's name, of which there must be one;
    ``variable`` names the state variable of a processor.
    """
    known = spark.read.format("state-metadata").load(checkpoint)
    found = {r.operatorId for r in known.select("operatorId", "operatorName").distinct().collect()
             if r.operatorName.lower().startswith(operator.lower())}
    if len(found) != 1:
        raise LookupError(f"{len(found)} operators of {checkpoint} begin with {operator!r}")
    reader = spark.read.format("statestore").option("operatorId", found.pop())
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def observed(df: DataFrame, *metrics: Column, name: str = "observed") -> tuple[DataFrame, Observation]:
    """The batch frame, and metrics gathered while it is written (no extra pass).

    Read ``observation.get`` after the write. On streams use ``df.observe(name, …)``:
    the values arrive in each progress report.
    """
    watch = Observation(name)
    return df.observe(watch, *metrics), watch
