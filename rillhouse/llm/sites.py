"""Document quality by hierarchical empirical Bayes.

A document classifier gives each document a chance of being good. A site's posterior adds up its
documents (known labels count as 0 or 1, others as their chance) and is shrunk toward the global
mean; a path's is shrunk toward its site's. How strongly is learnt from the spread between sites
and between the paths of a site (method of moments). The result adds the path's log odds,
taken without the document itself, to the document's. Sites and paths are sums per group,
combined before the shuffle, so a site with a third of all rows is no burden.

Null host or path: a group of its own. Null or empty text: its chance comes from the features of
the empty text. No labels: every chance is one half. Repeated rows are scored row by row; several
labels of a document count as their mean. Null labels don't count. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

_SMALL = 1e-4


def features(text: str | None) -> np.ndarray:
    """Shares of byte values (square roots), size, and how much of the text repeats itself."""
    raw = (text or "").encode("utf-8", "replace")
    out = np.zeros(261, np.float32)
    if raw:
        out[:256] = np.sqrt(np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw))
        words, lines = raw.split(), raw.split(b"\n")
        n = max(1, len(words))
        out[256] = np.log1p(len(words)) / 10
        out[257] = len(set(words)) / n
        out[258] = len(set(lines)) / len(lines)
        out[259] = len(raw) / n / 20
        out[260] = sum(w.isupper() for w in words) / n
    return out


def fit(rows: np.ndarray, good: np.ndarray, rounds: int = 400, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by accelerated gradient; standardised inside, returned plain with a
    bias as the last number."""
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = np.hstack([(rows - mean) / spread, np.ones((len(rows), 1))])
    w = np.zeros(x.shape[1])
    momentum, squares = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (chance - good) / len(good) + ridge * np.r_[w[:-1], 0]
        momentum = 0.9 * momentum + 0.1 * grad
        squares = 0.99 * squares + 0.01 * grad * grad
        w -= 0.05 * (momentum / (1 - 0.9 ** t)) / (np.sqrt(squares / (1 - 0.99 ** t)) + 1e-8)
    plain = w[:-1] / spread
    return np.r_[plain, w[-1] - plain @ mean]


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 10_000) -> np.ndarray | None:
    """Weights from a bounded sample: the ``max_labelled`` labelled ids first by hash."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    known = docs.join(F.broadcast(chosen), "doc_id")   # bounded by max_labelled

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [features(t).tobytes() for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), batch.column("good"),
                                           batch.column("doc_id")], ["x", "good", "doc_id"])
    sample = (common.arrow_pass(known.select("text", "good", "doc_id"),
                                "x binary, good double, doc_id long", each)
              .orderBy("doc_id", "x").limit(2 * max_labelled).collect())
    if not sample:
        return None
    return fit(np.stack([np.frombuffer(r.x, np.float32) for r in sample]).astype(np.float64),
               np.array([r.good for r in sample]))


def _shrunk(total: str, n: str, toward: Column, strength: Column) -> Column:
    return (F.col(total) + strength * toward) / (F.col(n) + strength)


def _strength(groups: DataFrame, mean: Column, parent: Sequence[str]) -> DataFrame:
    """How many documents' worth the parent's mean counts: m(1 - m) / variance between groups.

    The variance between is what the spread of group means has beyond the noise of their
    documents; where nothing is left, groups don't differ and the parent rules.
    """
    own = F.col("total") / F.col("n")
    off = (own - mean) ** 2
    noise = (F.col("square") / F.col("n") - own ** 2) / F.greatest(F.col("n") - 1, F.lit(1))
    spread = F.sum(F.col("n") * (off - noise)) / F.sum("n")
    return groups.agg((F.least(F.greatest(
        F.first(mean * (1 - mean)) / F.greatest(spread, F.lit(1e-6)), F.lit(1.0)),
        F.lit(1e6))).alias("strength"))


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(_SMALL)), F.lit(1 - _SMALL))
    return F.log(inside / (1 - inside))


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column,
          max_labelled: int = 10_000, keep_from: float = 0.5) -> DataFrame:
    """doc_id, host, path, p_doc, p_host, p_path, score, keep for every document."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("quality").cast("double").alias("good"))
             .where(F.col("doc_id").isNotNull() & F.col("good").isNotNull())
             .groupBy("doc_id").agg(F.avg("good").alias("good")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                       F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    weights = train(rows, known, max_labelled)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack([features(t) for t in batch.column("text").to_pylist()])
        odds = np.zeros(len(x)) if weights is None else x @ weights[:-1] + weights[-1]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), batch.column("path"),
             pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))))],
            ["doc_id", "host", "path", "p_doc"])
    scored = common.arrow_pass(rows, "doc_id long, host string, path string, p_doc double", each)
    evidence = common.written(
        scored.join(known, "doc_id", "left")
        .withColumn("y", F.coalesce("good", "p_doc")).drop("good"), "evidence")

    sums = [F.sum("y").alias("total"), F.sum(F.col("y") ** 2).alias("square"),
            F.count(F.lit(1)).alias("n")]
    paths = common.written(evidence.groupBy("host", "path").agg(*sums), "paths")
    again = [F.sum(c).alias(c) for c in ("total", "square", "n")]
    hosts = paths.groupBy("host").agg(*again)
    overall = hosts.agg(*again).first()
    mean = F.lit((overall.total / overall.n) if overall.n else 0.5)
    host_strength = F.lit(_strength(hosts, mean, []).first().strength or 1.0)
    with_host = hosts.select("host", _shrunk("total", "n", mean, host_strength).alias("p_host"))
    nested = paths.join(with_host, "host")
    path_strength = F.lit(_strength(nested, F.col("p_host"), ["host"]).first().strength or 1.0)
    side = nested.select("host", "path", "total", "n", "p_host")
    joined = common.with_side(evidence, side, ["host", "path"], "inner", paths.count())
    # The document's own share is taken out of its path before its odds are added.
    rest = ((F.col("total") - F.col("y") + path_strength * F.col("p_host"))
            / (F.col("n") - 1 + path_strength))
    final = _logit(F.col("p_doc")) + _logit(rest) - _logit(mean)
    return joined.select("doc_id", "host", "path", "p_doc", "p_host", rest.alias("p_path"),
                         (1 / (1 + F.exp(-final))).alias("score")).withColumn(
        "keep", F.col("score") >= keep_from)
