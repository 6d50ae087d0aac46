"""Distinct counts that can be stored and merged: HyperLogLog sketches per window.

A sketch of 2**k registers estimates a distinct count within a few of its standard error,
1.04 / sqrt(2**k), and sketches of parts unite to the sketch of the whole; so counts of days come
from stored hours, and of regions from stored provinces, without the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import windowed_agg

REGISTERS = 12   # as a power of two


def windowed_sketches(df: DataFrame, ts: str, size: str, column: str, keys: Sequence[str] = (),
                      delay: str | None = None, registers: int = REGISTERS) -> DataFrame:
    """startTime, endTime, date, keys and ``sketch`` of the distinct values of a column; null
    values don't count. Frames may be bounded or unbounded."""
    return windowed_agg(df, ts, size, [F.hll_sketch_agg(column, registers).alias("sketch")], keys,
                        delay=delay)


def united(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Stored sketches rolled up to coarser keys."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def within_error(estimated: Column, exact: Column, registers: int = REGISTERS, errors: float = 4
                 ) -> Column:
    """Does an estimate lie within ``errors`` standard errors (and half a value) of the exact count?"""
    return F.abs(estimated - exact) <= F.lit(errors * 1.04 / 2 ** (registers / 2)) * exact + 0.5
