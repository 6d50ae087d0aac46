"""Per-key visit logic: first visit of the day, gaps, new-device flag, late rows.

The rules are those of the keyed state machines. For batch frames they are written
as aggregates; ``first_of_day`` hands unbounded frames to the state processor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


DAY = "visit_date"
PREVIOUS = "previous_date"


def first_of_day(df: DataFrame, key: str | Sequence[str], ts: str, keep: Sequence[str] = (),
                 delay: str = "3 seconds", ttl_hours: int | None = None,
                 salts: int = 1) -> DataFrame:
    """First row of each key and day → key, ts, keep…, visit_date, previous_date.

    ``previous_date`` is the day of the key's visit before, null on the first one.
    Rows count in time order; equal times are ordered by ``keep``.

    Batch: within a key the day only grows with time, so the first row of a day is
    a minimum, and a minimum combines on the map side. Just the (key, day) pairs go
    through the window that finds the previous day; a key has no more of them than
    there are days, however many rows it has.

    Stream: one state entry per key. ``salts`` spreads the rows of a key over that
    many first-stage entries, ``ttl_hours`` forgets a key that long after the end of
    its last day (use it only where ``previous_date`` is not needed).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if df.isStreaming:
        from ..live.state import first_of_day_stream
        return first_of_day_stream(df, keys, ts, list(keep), delay, ttl_hours, salts)
    days = df.withColumn(DAY, F.to_date(ts))
    if keep:
        first = (days.groupBy(*keys, DAY).agg(F.min(F.struct(ts, *keep)).alias("_first"))
                 .select(*keys, DAY, "_first.*"))
    else:
        first = days.groupBy(*keys, DAY).agg(F.min(ts).alias(ts))   # hash-aggregated
    by_key = Window.partitionBy(*keys).orderBy(DAY)
    return (first.withColumn(PREVIOUS, F.lag(DAY).over(by_key))
            .select(*keys, ts, *keep, DAY, PREVIOUS))


def returned_after(days: int) -> Column:
    """1 when the visit before was more than ``days`` days ago, else 0."""
    gap = F.datediff(DAY, PREVIOUS)
    return F.when(gap > days, 1).otherwise(0)


def first_ever() -> Column:
    """1 on the first visit of all, else 0."""
    return F.when(F.col(PREVIOUS).isNull(), 1).otherwise(0)


FIRST_DATE, NEWEST = "first_date", "newest"


def _device_rows(df: DataFrame, ts: str, arrival: str, chunk_rows: int) -> DataFrame:
    return df.withColumns({"_chunk": F.expr(f"`{arrival}` div {int(chunk_rows)}"),
                           "_sec": F.unix_seconds(ts)})


def _lead_date(ts: str, flag: str, trust_reported_old: bool) -> Column:
    date = F.to_date(ts)
    if trust_reported_old:
        return F.when(F.col(flag) == "0", F.date_sub(date, 1)).otherwise(date)
    return date


def accept_and_flag(df: DataFrame, device: str, ts: str, arrival: str, flag: str = "is_new",
                    late_seconds: int = 5, trust_reported_old: bool = False,
                    chunk_rows: int = 1_000_000, carried: DataFrame | None = None) -> DataFrame:
    """Drop rows late for their device and correct the new-visitor flag.

    In arrival order per device: a row more than ``late_seconds`` (whole seconds)
    behind the newest one before it is dropped; the flag of the others is '1' on
    the date of the device's first row and '0' on any other date. With
    ``trust_reported_old`` a device whose first row says '0' counts as first seen
    the day before. ``carried`` holds what is known of devices from earlier rows
    (see ``device_records``).

    ``arrival`` is a unique whole number. It is cut into chunks of ``chunk_rows``:
    one small row per (device, chunk) carries the newest time and the first row,
    and the running maximum over those rows tells each chunk what came before it.
    The rows themselves are only ordered within their chunk, so no device, however
    busy, is sorted in one task.
    """
    rows = _device_rows(df, ts, arrival, chunk_rows)
    lead = F.struct(F.col(arrival).alias("a"), _lead_date(ts, flag, trust_reported_old).alias("d"))
    summary = (rows.groupBy(device, "_chunk")
               .agg(F.max("_sec").alias("_chunk_max"), F.min(lead).alias("_lead")))
    so_far = Window.partitionBy(device).orderBy("_chunk")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    known = summary.select(
        F.col(device).alias("_device"), F.col("_chunk").alias("_c"),
        F.max("_chunk_max").over(before).alias("_before"),
        F.first("_lead.d").over(so_far).alias("_first_date"))
    if carried is not None:
        past = carried.select(F.col(device).alias("_past"), FIRST_DATE, NEWEST)
        known = known.join(past, F.col("_device") == F.col("_past"), "left").select(
            "_device", "_c", F.greatest("_before", NEWEST).alias("_before"),
            F.coalesce(FIRST_DATE, "_first_date").alias("_first_date"))
    inside = (Window.partitionBy(device, "_chunk").orderBy(arrival)
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.join(known, (F.col(device) == F.col("_device")) & (F.col("_chunk") == F.col("_c")))
    newest = F.greatest(F.col("_before"), F.max("_sec").over(inside))
    kept = joined.withColumn("_newest", newest).where(
        F.col("_newest").isNull() | (F.col("_newest") - F.col("_sec") <= late_seconds))
    corrected = F.when(F.to_date(ts) == F.col("_first_date"), "1").otherwise("0")
    return kept.withColumn(flag, corrected).select(*df.columns)


def device_records(df: DataFrame, device: str, ts: str, arrival: str, flag: str = "is_new",
                   trust_reported_old: bool = False, carried: DataFrame | None = None) -> DataFrame:
    """What is known of each device after these rows: device, first_date, newest (seconds)."""
    lead = F.struct(F.col(arrival).alias("a"), _lead_date(ts, flag, trust_reported_old).alias("d"))
    seen = (df.groupBy(device).agg(F.max(F.unix_seconds(ts)).alias(NEWEST), F.min(lead).alias("_lead"))
            .select(device, F.col("_lead.d").alias(FIRST_DATE), NEWEST))
    if carried is None:
        return seen
    past = carried.select(F.col(device).alias("_past"), F.col(FIRST_DATE).alias("_d"),
                          F.col(NEWEST).alias("_n"))
    return seen.join(past, F.col(device) == F.col("_past"), "left").select(
        device, F.coalesce("_d", FIRST_DATE).alias(FIRST_DATE), F.greatest("_n", NEWEST).alias(NEWEST))
