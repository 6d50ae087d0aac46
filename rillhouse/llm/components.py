"""Connected components by alternating large-star and small-star steps on an edge table.

Each step is a minimum per node, combined before the shuffle, and a join on the node; a node
with very many neighbours is a skewed join, which adaptive execution splits. After every round
the edges are written to the shared scratch folder, which keeps the plan short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """node, component (its smallest node) for every node of an edge; null ends don't count."""
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where(
        "a <> b")
    e = common.written(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(lowest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # every edge now leads from a larger node to a smaller one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = common.written(small, "stars")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    stars = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
