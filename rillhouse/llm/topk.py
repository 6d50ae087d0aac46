"""Exact top-k by inner product over a pivot-distance index.

Vectors are whole numbers, floor(256 x). One more coordinate, sqrt(M - |v|^2) with M the largest
squared length (0 for queries), turns the largest inner product into the smallest distance:
d^2 = |q|^2 + M - 2 q.v. Each vector is keyed by its nearest pivot and its distance to it; sorted
by that key, runs of vectors are annuli around the pivots, packed as pages. A query block first
looks at the page whose annulus lies nearest, which bounds the distance of its k-th neighbour, then
at all annuli that the triangle inequality does not rule out with that bound: |d(q, pivot) - d(v,
pivot)| <= d(q, v). Scores are computed as exact whole numbers, so results are exact.

Pivots come from a bounded sample (``sample`` rows first by hash); they affect speed only. How much
the bounds rule out hangs on the vectors: distances between vectors of equal length in random
directions differ so little that no annulus is ruled out, and every pair is then scored.

Rows whose id or vector is null, or whose vector holds null or non-finite numbers, take no part.
Shorter vectors count as filled up with zeros. Rows with one id count once, with their best score,
and never as candidates of the query with that id. Ties go to the smaller id; with fewer than k
candidates all are returned. An empty table or no query gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, pages

_PAGE = ("cell int, low double, high double, n int, ids binary, vectors binary, bounds binary")


def _augmented(vectors: np.ndarray, longest: int, query: bool) -> np.ndarray:
    x = vectors.astype(np.float64)
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest - (x * x).sum(1), 0))
    return np.hstack([x, extra[:, None]])


def _slack(longest: int) -> float:
    """Above the rounding of distances in double precision."""
    return 1e-6 * (1.0 + np.sqrt(float(longest)))


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole-number inner products; by doubles only where every sum is exact in them."""
    most = (float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0))
            * queries.shape[1])
    if most < 2 ** 53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k best candidates: highest score, then smallest id, each id once."""
    allowed = np.flatnonzero(ids != own)
    if len(allowed) > 4 * k:   # what reaches the k-th score, ties included
        cut = np.partition(scores[allowed], -3 * k)[-3 * k]
        short = allowed[scores[allowed] >= cut]
        if len(np.unique(ids[short])) >= k:
            allowed = short
    order = allowed[np.lexsort((ids[allowed], -scores[allowed]))]
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def _index(rows: DataFrame, pivots: np.ndarray, longest: int, width: int, query: bool,
           size: int, partitions: int) -> DataFrame:
    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _augmented(pages.matrix(batch.column("v"), width), longest, query)
        d2 = pages.squared_distances(x, pivots)
        cell = d2.argmin(axis=1)
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("v"), pa.array(cell.astype(np.int32)),
             pa.array(np.sqrt(d2[np.arange(len(x)), cell]))], ["vec_id", "v", "cell", "d"])

    def pack(table: pa.Table) -> dict:
        table = table.combine_chunks()
        v = pages.matrix(table.column("v").chunk(0), width)
        d = table.column("d").to_numpy()
        return {"cell": table.column("cell")[0].as_py(), "low": float(d.min()),
                "high": float(d.max()), "n": table.num_rows,
                "ids": table.column("vec_id").to_numpy().tobytes(), "vectors": v.tobytes(),
                "bounds": None}
    made = common.arrow_pass(rows, "vec_id long, v array<long>, cell int, d double", keyed)
    return pages.paged(made, ["cell"], ["d", "vec_id"], size, partitions, pack, _PAGE)


def search(table: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding",
           pivots: int = 32, sample: int = 4096, page: int = 1024, block: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score for every query row against every row but its own."""
    spark = table.sparkSession
    plain = table.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col(vector).cast("array<double>").alias("v"),
                         F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = plain.where(F.col("vec_id").isNotNull() & pages.usable("v")).select(
        "vec_id", F.transform("v", lambda x: F.floor(256 * x)).alias("v"), "query")
    squares = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    facts = rows.agg(F.max(squares).alias("longest"), F.max(F.size("v")).alias("width"),
                     F.count(F.lit(1)).alias("n")).first()
    longest, width = facts.longest or 0, max(facts.width or 0, 1)
    drawn = pages.drawn(rows, "vec_id", sample, facts.n).select("v").collect()
    out = "query_id long, rank int, vec_id long, score long"
    if not facts.n:
        return spark.createDataFrame([], out)
    padded = np.array([list(r.v) + [0] * (width - len(r.v)) for r in drawn], np.int64)
    centres = pages.kmeans(_augmented(padded, longest, False), pivots)
    n = pages.partitions(spark)
    annuli = common.written(_index(rows.select("vec_id", "v"), centres, longest, width, False,
                                   page, n), "annuli")
    asked = rows.where("query").groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = common.written(_index(asked, centres, longest, width, True, block, n), "query-blocks")

    def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
        return (np.frombuffer(row["ids"], np.int64),
                np.frombuffer(row["vectors"], np.int64).reshape(-1, width))

    def reach(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Per query block and pivot: where its queries lie."""
        made = []
        for r in batch.to_pylist():
            d = np.sqrt(pages.squared_distances(
                _augmented(unpacked(r)[1], longest, True), centres))
            made += [(r["page"], c, float(d[:, c].min()), float(d[:, c].max()))
                     for c in range(len(centres))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*made), (
                pa.int64(), pa.int32(), pa.float64(), pa.float64()))], ["block", "cell", "near", "far"])

    heads = annuli.select(F.col("page"), "cell", "low", "high", "n")
    where = common.arrow_pass(blocks, "block long, cell int, near double, far double", reach)
    gap = F.greatest(F.col("near") - F.col("high"), F.col("low") - F.col("far"), F.lit(0.0))
    # A page of more than k rows bounds the k-th neighbour of every query of the block.
    seeds = (where.join(heads.where(F.col("n") > k), "cell")
             .groupBy("block").agg(F.min(F.struct(gap.alias("gap"), F.col("near"), F.col("page")))
                                   .alias("seed"))
             .select("block", F.col("seed.page").alias("page")))

    def bounded(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Adds to a query block the k-th best score its seed page gives each query."""
        made = []
        for r in batch.to_pylist():
            ids, q = unpacked(r)
            kth = np.full(len(ids), np.iinfo(np.int64).min)
            if r["seed_ids"] is not None:
                cand = np.frombuffer(r["seed_ids"], np.int64)
                got = exact_scores(q, np.frombuffer(r["seed_vectors"], np.int64).reshape(-1, width))
                for i, own in enumerate(ids):
                    top = best(got[i], cand, own, k)
                    if len(top) == k:
                        kth[i] = got[i, top[-1]]
            x = _augmented(q, longest, True)
            d = np.sqrt(pages.squared_distances(x, centres))
            length = (x * x).sum(1)
            radius = np.where(kth == np.iinfo(np.int64).min, np.inf,
                              np.sqrt(np.maximum(length + longest - 2.0 * kth, 0)) + _slack(longest))
            for c in range(len(centres)):
                made.append((r["page"], c, float((d[:, c] - radius).min()),
                             float((d[:, c] + radius).max()), kth.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*made), (
                pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary()))],
            ["block", "cell", "from", "to", "kth"])

    seeded = (blocks.join(seeds.select(F.col("block").alias("page"), F.col("page").alias("seed")),
                          "page", "left")
              .join(annuli.select(F.col("page").alias("seed"), F.col("ids").alias("seed_ids"),
                                  F.col("vectors").alias("seed_vectors")), "seed", "left"))
    reached = common.written(common.arrow_pass(
        seeded, "block long, cell int, `from` double, `to` double, kth binary", bounded), "reach")
    # Annuli that some query of the block may need: light rows of numbers only.
    visits = reached.join(heads, "cell").where(
        (F.col("high") >= F.col("from")) & (F.col("low") <= F.col("to"))).select(
        "block", "page", "kth")
    pairs = (visits.join(annuli.select("page", "cell", "low", "high", "ids", "vectors"), "page")
             .join(blocks.select(F.col("page").alias("block"), F.col("ids").alias("q_ids"),
                                 F.col("vectors").alias("q_vectors")), "block"))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for r in batch.to_pylist():
            ids, v = unpacked(r)
            own = np.frombuffer(r["q_ids"], np.int64)
            q = np.frombuffer(r["q_vectors"], np.int64).reshape(-1, width)
            kth = np.frombuffer(r["kth"], np.int64)
            x = _augmented(q, longest, True)
            d = np.sqrt(pages.squared_distances(x, centres[r["cell"]][None]))[:, 0]
            radius = np.where(kth == np.iinfo(np.int64).min, np.inf, np.sqrt(np.maximum(
                (x * x).sum(1) + longest - 2.0 * kth, 0)) + _slack(longest))
            open_ = np.flatnonzero((d - radius <= r["high"]) & (d + radius >= r["low"]))
            if not len(open_):
                continue
            got = exact_scores(q[open_], v)
            for i, row in zip(open_, got):
                some = np.flatnonzero(row >= kth[i])
                if len(some):
                    top = some[best(row[some], ids[some], own[i], k)]
                    made += [(int(own[i]), int(ids[j]), int(row[j])) for j in top]
        return pa.RecordBatch.from_arrays(
            [pa.array([m[c] for m in made], pa.int64()) for c in range(3)],
            ["query_id", "vec_id", "score"])

    found = common.arrow_pass(pairs.select("page", "cell", "low", "high", "ids", "vectors", "kth",
                                           "q_ids", "q_vectors"),
                              "query_id long, vec_id long, score long", scan)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
