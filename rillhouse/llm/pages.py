"""Pages of vectors: sorted runs packed for array work, and pairs of pages brought together.

A page holds consecutive rows of one cell as two packed arrays, ids and vectors. Pages are made
from range-partitioned rows, so one cell may fill many pages in many tasks, and pairs of pages
are joined by page number, so what meets in a task is two pages at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def kmeans(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Centres of a bounded sample; fewer where it has fewer distinct rows."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:k]]
    for _ in range(rounds):
        near = squared_distances(rows, centres).argmin(axis=1)
        for c in range(len(centres)):
            mine = rows[near == c]
            if len(mine):
                centres[c] = mine.mean(axis=0)
    return centres


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.maximum(found, 0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, short ones filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), flat.dtype)
    out[np.arange(width)[None] < lengths[:, None]] = flat
    return out


def paged(rows: DataFrame, keys: list[str], order: list[str], size: int, partitions: int,
          pack: Callable[[pa.Table], dict], schema: str) -> DataFrame:
    """Sort rows by keys and order over the cluster and pack runs of at most ``size`` rows of
    equal keys by ``pack``, which gives the page's fields; ``page`` numbers them."""
    def run(batches):
        task, nth, kept = TaskContext.get().partitionId(), 0, []

        def closed(table: pa.Table) -> pa.RecordBatch:
            nonlocal nth
            made = {"page": (task << 33) + nth, **pack(table)}
            nth += 1
            return pa.RecordBatch.from_pylist([made], arrow)

        held = 0
        for batch in common.small(batches):
            at = 0
            while at < batch.num_rows:
                first = [kept[0].column(k)[0] if kept else batch.column(k)[at] for k in keys]
                part = batch.slice(at, size - held)
                same = np.ones(part.num_rows, bool)
                for k, value in zip(keys, first):
                    same &= (part.column(k).to_numpy(zero_copy_only=False) == value.as_py())
                n = part.num_rows if same.all() else int(same.argmin())
                if n:
                    kept.append(part.slice(0, n))
                    held, at = held + n, at + n
                if held == size or n < part.num_rows:
                    yield closed(pa.Table.from_batches(kept))
                    kept, held = [], 0
        if kept:
            yield closed(pa.Table.from_batches(kept))

    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    out = "page long, " + schema
    arrow = to_arrow_schema(_parse_datatype_string(out))
    return (rows.repartitionByRange(partitions, *keys, *order).sortWithinPartitions(*keys, *order)
            .mapInArrow(run, out))


def usable(column: str):
    """A vector with at least no null and no non-finite number in it."""
    far = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~F.coalesce(far, F.lit(False))


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def drawn(rows: DataFrame, key: str, size: int, n: int) -> DataFrame:
    """At most ``size`` of ``n`` rows, by a hash of the key; tasks hand over about that many."""
    even = F.pmod(F.xxhash64(key, F.lit("drawn")), F.lit(1_000_000))
    share = 1_000_000 * min(1.0, 1.5 * size / max(1, n))
    return rows.where(even <= share).orderBy(F.xxhash64(key), key).limit(size)
