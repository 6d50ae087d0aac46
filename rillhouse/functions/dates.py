"""Date and time helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
DASHED_SECOND = "yyyy-MM-dd HH-mm-ss"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_text(ts: str | Column) -> Column:
    """Timestamp, date or timestamp text → ``yyyy-MM-dd`` (the partition column)."""
    return F.date_format(_c(ts).try_cast("timestamp"), DATE)


def millis_to_seconds_ts(millis: str | Column) -> Column:
    """Epoch milliseconds → timestamp cut to whole seconds."""
    return F.timestamp_seconds(F.floor(_c(millis) / F.lit(1000)))


def millis_date_text(millis: str | Column) -> Column:
    """Epoch milliseconds → ``yyyy-MM-dd``."""
    return F.date_format(F.timestamp_millis(_c(millis)), DATE)


def add_days_text(date: str | Column, days: int) -> Column:
    """``yyyy-MM-dd`` shifted by ``days``, as text."""
    return F.date_format(F.date_add(F.to_date(_c(date), DATE), days), DATE)


def seconds_between(first: str | Column, second: str | Column) -> Column:
    """``second - first`` in seconds for ``yyyy-MM-dd HH-mm-ss`` texts."""
    return (F.unix_timestamp(_c(second), DASHED_SECOND)
            - F.unix_timestamp(_c(first), DASHED_SECOND))


def days_between(first: str | Column, second: str | Column) -> Column:
    """``second - first`` in days for ``yyyy-MM-dd`` texts."""
    return F.datediff(F.to_date(_c(second), DATE), F.to_date(_c(first), DATE))


def parse_ts(text: str | Column) -> Column:
    """Text → timestamp, null when it is not one (ANSI mode would raise)."""
    return _c(text).try_cast("timestamp")


def number(text: str | Column, kind: str = "double") -> Column:
    """Text → number, null when it is not one."""
    return _c(text).try_cast(kind)
