"""Applying a set of changes to a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import names as N
from .cdc import latest_per_key


@dataclass(frozen=True)
class Policy:
    """Which kinds of change may create a row and which replace an existing one.

    ``None`` means every kind but delete. A delete always removes.
    """

    creates: tuple[str, ...] | None
    replaces: tuple[str, ...] | None


# A missing row is created by inserts only; a repeated insert changes nothing.
STRICT = Policy(creates=N.INSERT_KINDS, replaces=(N.UPDATE,))
# A missing row is created by anything but a delete.
UPSERT = Policy(creates=None, replaces=(N.UPDATE,))
# Row-key store: the last write is the whole row.
REPLACE = Policy(creates=None, replaces=None)


def _kind_in(op: str, kinds: tuple[str, ...] | None):
    return F.col(op) != N.DELETE if kinds is None else F.col(op).isin(*kinds)


def fold_changes(changes: DataFrame, key: str, order_by: Sequence[str], op: str,
                 policy: Policy, columns: Sequence[str]) -> DataFrame:
    """Reduce the changes to one row per key with the effect of applying them in order.

    Result: ``key``, ``_cut`` (a delete happened), ``_made`` (row if the key was
    absent) and ``_kept`` (row that replaces a present one, null = unchanged).
    Only changes after the key's last delete matter. Every step is an aggregate
    with a map-side part, or a join against one row per key, so a key changed
    very often is not gathered in one task.
    """
    seq = F.struct(*order_by)
    cuts = (changes.where(F.col(op) == N.DELETE)
            .groupBy(F.col(key).alias("_key")).agg(F.max(seq).alias("_cut_at")))
    row = F.struct(*columns)
    creates, replaces = _kind_in(op, policy.creates), _kind_in(op, policy.replaces)
    tail = (changes.join(cuts, F.col(key) == F.col("_key"), "left").drop("_key")
            .withColumn("_live", F.col("_cut_at").isNull() | (seq > F.col("_cut_at"))))

    def when(test):
        return F.when(F.col("_live") & test, seq)

    folded = tail.groupBy(key).agg(
        F.max(F.col("_cut_at").isNotNull()).alias("_cut"),
        F.min(when(creates)).alias("_first_at"),
        F.min_by(row, when(creates)).alias("_first"),
        F.max(when(replaces)).alias("_last_at"),
        F.max_by(row, when(replaces)).alias("_last"))
    return folded.select(
        key, "_cut",
        F.when(F.col("_first_at").isNull(), None)
         .when(F.col("_last_at") > F.col("_first_at"), F.col("_last"))
         .otherwise(F.col("_first")).alias("_made"),
        F.col("_last").alias("_kept"))


def apply_changes(target: DataFrame, changes: DataFrame, key: str, order_by: Sequence[str],
                  op: str = "type", policy: Policy = STRICT) -> DataFrame:
    """The target table after the changes; ``target`` must hold each key once."""
    folded = fold_changes(typed_as(target, changes), key, order_by, op, policy, target.columns)
    return apply_folded(target, folded, key)


def typed_as(target: DataFrame, changes: DataFrame) -> DataFrame:
    """The changes with the target's column types."""
    return changes.withColumns({c: F.col(c).cast(target.schema[c].dataType) for c in target.columns})


def apply_folded(target: DataFrame, folded: DataFrame, key: str) -> DataFrame:
    """The target after changes that ``fold_changes`` folded; hold them (``persist``) if they are
    costly, as they are met three times here.

    The target side is joined twice from the left, once whole and once by key
    only, instead of with a full outer join: the folded changes are the small
    side of a micro-batch, and these forms let Spark broadcast them when their
    size allows, leaving the target unshuffled. Beyond that both are plain
    sort-merge joins on the unique key.
    """
    columns = target.columns
    folded = folded.withColumnRenamed(key, "_k")
    touched = F.col("_k").isNotNull()
    joined = target.join(folded, F.col(key) == F.col("_k"), "left")
    # After a cut the old row is gone, so only a created row may stand.
    after = F.when(F.coalesce("_cut", F.lit(False)), F.col("_made")) \
             .otherwise(F.coalesce("_kept", F.struct(*columns)))
    stay = (joined.select(F.when(touched, after).otherwise(F.struct(*columns)).alias("_row"))
            .where(F.col("_row").isNotNull()).select("_row.*"))
    # The changed keys that the target has: as many rows as the changes at most, found from the
    # target's side, so that neither join has to bring the target's keys together.
    present = target.select(key).join(folded.select("_k"), F.col(key) == F.col("_k"), "left_semi")
    new = (folded.where(F.col("_made").isNotNull())
           .join(present, F.col(key) == F.col("_k"), "left_anti").select("_made.*"))
    return stay.unionByName(new)


def upsert_replace(old: DataFrame, batch: DataFrame, keys: Sequence[str],
                   order_by: Sequence[str] = ()) -> DataFrame:
    """Keyed replace: rows of ``batch`` take the place of rows with the same keys.

    One aggregation over the union, so keys may be null and nothing is joined.
    """
    order = ["_gen", *order_by]
    both = old.withColumn("_gen", F.lit(0)).unionByName(batch.withColumn("_gen", F.lit(1)))
    return latest_per_key(both, keys, order).drop("_gen")


def stringify(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as text, as a row-key store holds its cells."""
    return df.select(*[F.col(c) if c in keep else F.col(c).cast("string").alias(c)
                       for c in df.columns])
