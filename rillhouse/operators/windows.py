"""Event-time windowed metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SECOND


def windowed_agg(df: DataFrame, ts: str, size: str, aggs: Sequence[Column],
                 keys: Sequence[str] = (), slide: str | None = None, delay: str | None = None,
                 date_from: str = "start") -> DataFrame:
    """Tumbling (or sliding) window metrics → startTime, endTime, date, keys, aggregates.

    The bounds are second-precision texts and ``date`` is the day of the window's
    start or end. ``delay`` sets the watermark of a stream; leave it out when the
    frame already carries one. Only partial aggregates are shuffled.
    """
    if date_from not in ("start", "end"):
        raise ValueError(f"date_from is 'start' or 'end', not {date_from!r}")
    if delay is not None and df.isStreaming:
        df = df.withWatermark(ts, delay)
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(span.alias("_window"), *keys).agg(*aggs)
    metrics = [c for c in grouped.columns if c != "_window" and c not in keys]
    return grouped.select(
        F.date_format("_window.start", SECOND).alias("startTime"),
        F.date_format("_window.end", SECOND).alias("endTime"),
        F.to_date(F.col(f"_window.{date_from}")).alias("date"),
        *keys, *metrics)


def union_flagged(*parts: DataFrame) -> DataFrame:
    """Union by name of streams that each carry their own count columns; the others' are 0."""
    columns = {c: part.schema[c].dataType for part in parts for c in part.columns}

    def padded(part: DataFrame) -> DataFrame:
        return part.select(*[F.col(c) if c in part.columns else F.lit(0).cast(kind).alias(c)
                             for c, kind in columns.items()])

    first, *rest = map(padded, parts)
    for part in rest:
        first = first.unionByName(part)
    return first
