"""Interval joins and dimension lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOT = "_slot"


def _seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def _slot_of(ts: Column, width: int) -> Column:
    return F.floor(_seconds(ts) / F.lit(width))


@dataclass(frozen=True)
class Interval:
    """Right side of an interval join.

    A pair matches when the keys are equal and the left time lies in
    ``[right time + lower, right time + upper]`` (seconds).
    """

    frame: DataFrame
    key: str
    ts: str
    lower: int
    upper: int
    how: str = "inner"
    keep: Sequence[str] | None = None

    @property
    def width(self) -> int:
        return max(self.upper - self.lower, 1)


def _narrow(right: Interval, suffix: str, width: int, slots: bool) -> tuple[DataFrame, list[str]]:
    """Right side with its join columns renamed apart and one row per time slot it can reach."""
    kept = list(right.keep if right.keep is not None
                else [c for c in right.frame.columns if c not in (right.key, right.ts)])
    cols = [F.col(right.key).alias(f"_key{suffix}"), F.col(right.ts).alias(f"_ts{suffix}"),
            *[F.col(c) for c in kept]]
    if slots:
        first = F.floor((_seconds(F.col(right.ts)) + F.lit(right.lower)) / F.lit(width))
        last = F.floor((_seconds(F.col(right.ts)) + F.lit(right.upper)) / F.lit(width))
        cols.append(F.explode(F.sequence(first, last)).alias(f"{_SLOT}{suffix}"))
    return right.frame.select(*cols), kept


def chain_interval_joins(left: DataFrame, key: str | Sequence[str], ts: str,
                         rights: Sequence[Interval], split_hot_keys: bool = True,
                         slot_seconds: int | None = None) -> DataFrame:
    """Join ``left`` with each right side in turn, every time on its own key and time.

    ``key`` is the left key, one for all steps or one per step. With
    ``split_hot_keys`` the equality part also holds a time slot as wide as the
    widest interval: a left row lies in one slot and a right row is repeated into
    the two (at most) its interval touches, so each pair still meets exactly once,
    but the rows of one key spread over as many tasks as there are slots, and no
    task compares all pairs of a key. The left slot is computed once, so steps
    that share the key also share the shuffle.

    Where one key has very many rows within one interval, give narrower slots
    (``slot_seconds``): a right row is then repeated into all slots it reaches, about
    interval / slot of them, and the left rows of the key spread over as many tasks.

    As streams, all sides need watermarks. The right time is dropped after each
    step, because a stream may carry only one event-time column onward.
    """
    keys = [key] * len(rights) if isinstance(key, str) else list(key)
    width = slot_seconds or max(r.width for r in rights)
    out_columns = list(left.columns)
    current = left.withColumn(_SLOT, _slot_of(F.col(ts), width)) if split_hot_keys else left
    for at, (left_key, right) in enumerate(zip(keys, rights, strict=True)):
        suffix = str(at)
        side, kept = _narrow(right, suffix, width, split_hot_keys)
        right_ts = f"_ts{suffix}"
        match = (F.col(left_key) == F.col(f"_key{suffix}")) & F.expr(
            f"`{ts}` >= {right_ts} + INTERVAL '{right.lower}' SECOND"
            f" AND `{ts}` <= {right_ts} + INTERVAL '{right.upper}' SECOND")
        drop = [f"_key{suffix}", right_ts]
        if split_hot_keys:
            match = match & (F.col(_SLOT) == F.col(f"{_SLOT}{suffix}"))
            drop.append(f"{_SLOT}{suffix}")
        current = current.join(side, match, right.how).drop(*drop)
        out_columns += kept
    return current.select(*out_columns)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, lower: int, upper: int, how: str = "inner",
                  keep: Sequence[str] | None = None, split_hot_keys: bool = True,
                  slot_seconds: int | None = None) -> DataFrame:
    """Equal keys and left time within ``[right time + lower, right time + upper]`` seconds."""
    side = Interval(right, right_key, right_ts, lower, upper, how, keep)
    return chain_interval_joins(left, left_key, left_ts, [side], split_hot_keys, slot_seconds)


def dictionary_entries(dictionary: DataFrame, parent: str | int) -> DataFrame:
    """Codes and names of one section of the dictionary table."""
    return (dictionary.where(F.col("parent_code").cast("string") == str(parent))
            .select("dic_code", "dic_name"))


def dictionary_join(df: DataFrame, dictionary: DataFrame, parent: str | int, code: str,
                    name: str | None = None) -> DataFrame:
    """Add the dictionary name of ``code``; without ``name`` it replaces the code.

    Codes that are not in the dictionary give null. No broadcast hint is set:
    Spark broadcasts the dictionary while its size is below the session's
    threshold and shuffles otherwise.
    """
    target = name or code
    entries = dictionary_entries(dictionary, parent)
    joined = df.join(entries, F.col(code) == F.col("dic_code"), "left")
    return joined.withColumn(target, F.col("dic_name")).drop("dic_code", "dic_name")


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, take: Mapping[str, str],
           default: str | None = None) -> DataFrame:
    """Left lookup by key: ``take`` maps dimension columns to output names.

    ``dim`` holds each key once. Missing keys give null, or ``default``.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"),
                      *[F.col(src).alias(out) for src, out in take.items()])
    joined = df.join(side, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")
    if default is None:
        return joined
    return joined.withColumns({out: F.coalesce(F.col(out), F.lit(default)) for out in take.values()})


@dataclass(frozen=True)
class Hop:
    """One step of a snowflake lookup; ``key`` may come from an earlier step.

    ``dim`` is the dimension, or is called with the rows found so far and reads it for them.
    """

    dim: DataFrame | Callable[[DataFrame], DataFrame]
    key: str
    dim_key: str
    take: Mapping[str, str]


def snowflake_lookup(df: DataFrame, hops: Sequence[Hop]) -> DataFrame:
    """Follow several dimensions one after the other."""
    for hop in hops:
        dim = hop.dim(df) if callable(hop.dim) else hop.dim
        df = lookup(df, dim, hop.key, hop.dim_key, hop.take)
    return df
