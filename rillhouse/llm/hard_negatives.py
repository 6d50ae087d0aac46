"""Hard negatives by exact inner product over a cover tree.

Vectors are whole numbers, floor(256 x). One more coordinate, sqrt(M - |v|^2) with M the largest
squared length, puts all candidates on one sphere, and an anchor gets 0 there, so that an inner
product is |anchor| sqrt(M) times the cosine of the angle between the two. Angles obey the triangle
inequality. A cover tree is laid over a sample of candidates: the centres of a level lie further
apart than its width, each within the width above of its parent, and widths halve from level to
level. Every candidate then goes below its nearest lowest centre, and each node's covering radius is
measured, the largest angle of all rows below it. An anchor at angle t from a centre of radius r has
no score above |anchor| sqrt(M) cos(t - r) and none below that of t + r under the node.

A search asks for the k best scores within windows of scores (negatives must lie between shares of
the positive's score). It goes down the tree level by level and leaves out nodes whose bounds lie
outside all windows still open. The lowest nodes left are taken best bound first: the first few give
each window its k-th score so far, and the second descent takes all that can still reach it. Below
the tree lie pages of rows, of one lowest node each and sorted by angle; every row of a page that is
reached is scored exactly. So the sample decides about speed only, and results are exact.

Pages are dealt to groups of neighbouring nodes, of about ``group`` bytes each. Anchors are sent, packed,
once to every group in which they reach a node, by a shuffle: a task holds a group while its anchors
stream by and hands on the k best of each window. The driver holds the tree and a few numbers a lowest
node, whatever the rows and anchors. Of rows with one label and one vector only as many as can be
asked for (the smallest ids) enter the tree: a group of copies of any size costs no more.

Rows without id, label or vector, or whose vector holds null or non-finite numbers, take no part.
Shorter vectors count as filled up with zeros. Of rows that share an id the smallest (label, vector)
counts. Ties go to the smaller id; with fewer rows than asked for, all are returned. An empty table
and a table without anchors give no rows. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, pages
from .topk import exact_scores

NO_LIMIT = 1 << 62
_SLACK = 1e-6   # of the largest possible score: far above the rounding of angles


def units(vectors: np.ndarray, longest: int, query: bool) -> np.ndarray:
    """Vectors with the added coordinate, scaled to length one; zero queries stay zero."""
    x = vectors.astype(np.float64)
    squares = (x * x).sum(1)
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest - squares, 0))
    if not query and not longest:
        extra[:] = 1.0
    out = np.hstack([x, extra[:, None]])
    length = np.sqrt((out * out).sum(1))
    return out / np.where(length > 0, length, 1)[:, None]


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _nearest(a: np.ndarray, b: np.ndarray, rows: int = 256) -> np.ndarray:
    """The place in ``b`` of each row's nearest one, some rows at a time: the driver holds this."""
    return np.concatenate([angles(a[at:at + rows], b).argmin(1) for at in range(0, len(a), rows)])


class CoverTree:
    """Levels of nested centres. ``centres`` holds each once; ``level[l]`` are those of level l,
    ``above[l]`` the place of each one's parent in level l - 1, ``radius[l]`` their radii."""

    def __init__(self, sample: np.ndarray, depth: int = 10):
        self.centres = sample
        nearest, chosen = np.full(len(sample), np.inf), np.zeros(0, np.int64)
        self.level, self.above = [], []
        for nth in range(depth + 1):
            width = math.pi / 2 ** nth
            before = chosen
            while len(sample):
                far = int(nearest.argmax()) if len(chosen) else 0
                if nearest[far] <= width:
                    break
                chosen = np.append(chosen, far)
                nearest = np.minimum(nearest, angles(sample, sample[far:far + 1])[:, 0])
            if len(chosen) == len(before) and nth:
                continue   # a level like the one above
            self.level.append(chosen)
            self.above.append(_nearest(sample[chosen], sample[before]) if len(before)
                              else np.zeros(len(chosen), np.int64))
        # Where each lowest centre's ancestors stand in their levels.
        place = np.arange(len(self.level[-1]))
        self.path = [place]
        for above in reversed(self.above[1:]):
            place = above[place]
            self.path.insert(0, place)
        self.lowest = sample[self.level[-1]]
        self.radius: list[np.ndarray] = []

    def below(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest node of each row, and the row's angle to that node's centre and to those
        above it, highest level first."""
        to = angles(x, self.lowest)
        leaf = to.argmin(1)
        far = [np.arccos(np.clip((x * self.centres[level[path[leaf]]]).sum(1), -1, 1))
               for level, path in zip(self.level, self.path)]
        return leaf, np.stack(far, axis=1)

    def measured(self, far: dict[int, np.ndarray]) -> None:
        """Covering radii from the largest angles met under each lowest node; -1: nothing there."""
        self.radius = []
        for nth, (level, path) in enumerate(zip(self.level, self.path)):
            radius = np.full(len(level), -1.0)
            for leaf, most in far.items():
                radius[path[leaf]] = max(radius[path[leaf]], most[nth])
            self.radius.append(radius)

    def reached(self, x: np.ndarray, scale: np.ndarray, low: np.ndarray, high: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
        """For anchors with windows [low, high] (anchor × window): which lowest nodes each may need,
        and the upper bounds of their scores."""
        alive = upper = None
        for nth, level in enumerate(self.level):
            t, r = angles(x, self.centres[level]), self.radius[nth][None]
            upper = scale[:, None] * (np.cos(np.maximum(t - r, 0)) + _SLACK)
            lower = scale[:, None] * (np.cos(np.minimum(t + r, math.pi)) - _SLACK)
            mine = np.zeros(t.shape, bool)
            for w in range(low.shape[1]):
                mine |= (upper >= low[:, w:w + 1]) & (lower <= high[:, w:w + 1])
            mine &= r >= 0
            alive = mine if alive is None else mine & alive[:, self.above[nth]]
        return alive, upper


_PAGE = "leaf int, n int, ids binary, labels binary, vectors binary, far array<double>"
_ANCHOR = "vec_id long, label long, v array<long>, low array<long>, high array<long>"
_SENT = ("grp int, asked int, a_ids binary, a_labels binary, a_vectors binary, low binary, "
         "high binary, nodes binary")
_FOUND = "anchor long, nth int, vec_id long, score long"
_SENT_BYTES = 16 << 20    # of packed anchors in one batch of a task
_HITS = 200_000           # rows kept before they are cut to the best


def _packed(v: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold all of them."""
    most = max(-int(v.min(initial=0)), int(v.max(initial=0)))
    return v.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64).tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (rows * width)]
    return np.frombuffer(data, kind).reshape(rows, width)


class _Best:
    """The k best rows of each anchor and window met so far; ``low`` rises with the k-th score."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray):
        self.k, self.low, self.high = k, low.copy(), high
        self.kept = [[np.zeros(0, np.int64)] * 3 for _ in range(low.shape[1])]
        self.hits: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.hits.append((who, ids, scores))
        self.waiting += len(who)
        if self.waiting > _HITS:
            self.cut()

    def cut(self) -> None:
        if not self.hits:
            return
        who, ids, scores = (np.concatenate(c) for c in zip(*self.hits))
        self.hits, self.waiting = [], 0
        for w, kept in enumerate(self.kept):
            fit = (scores >= self.low[who, w]) & (scores <= self.high[who, w])
            i, n, s = (np.concatenate([old, new[fit]]) for old, new in zip(kept, (who, ids, scores)))
            order = np.lexsort((n, -s, i))
            i, n, s = i[order], n[order], s[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            last = rank == self.k - 1
            self.low[i[last], w] = np.maximum(self.low[i[last], w], s[last])
            self.kept[w] = [c[rank < self.k] for c in (i, n, s)]

    def found(self, own: np.ndarray) -> list[np.ndarray]:
        self.cut()
        return [np.stack([own[i], np.full(len(i), w), n, s], axis=1)
                for w, (i, n, s) in enumerate(self.kept) if len(i)]


class Index:
    """Candidates below a cover tree; made by ``build``. ``groups`` has of each lowest node with rows
    its first group of pages and the number of groups that share its pages."""

    def __init__(self, spark, tree: CoverTree, stored: DataFrame, longest: int, width: int,
                 groups: dict[int, tuple[int, int]]):
        self.spark, self.tree, self.stored = spark, tree, stored
        self.longest, self.width, self.groups = longest, width, groups
        nodes: dict[int, list[int]] = {}
        for leaf, (start, span) in groups.items():
            for g in range(start, start + span):
                nodes.setdefault(g, []).append(leaf)
        self.nodes = {g: np.array(nodes[g]) for g in sorted(nodes)}

    def search(self, anchors: DataFrame, k: int, same: bool, first: int = 2) -> DataFrame:
        """anchor, nth, rank, vec_id, score: the k best rows of the anchor's label (or of all other
        labels) within its nth window; ``anchors`` has the columns of ``_ANCHOR``."""
        seeds = self._scanned(anchors, k, same, first)
        kth = (self._ranked(seeds, k).where(F.col("rank") == k)
               .groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("nth", "score")))
                                      .alias("kth")))
        at_least = F.transform("low", lambda x, i: F.greatest(
            x, F.coalesce(F.try_element_at("kth", i), F.lit(-NO_LIMIT))))
        closer = common.written(
            anchors.join(kth.withColumnRenamed("anchor", "vec_id").hint("merge"), "vec_id", "left")
            .withColumn("low", F.when(F.col("kth").isNull(), F.col("low")).otherwise(at_least))
            .drop("kth"), "anchors")
        return self._ranked(self._scanned(closer, k, same, None), k)

    def _reaching(self, first: int | None):
        """Of a batch of anchors: ids, labels, vectors, windows, and which lowest nodes each has to
        look at; only the ``first`` of them in the order of their bounds, if given."""
        tree, longest, width = self.tree, self.longest, self.width

        def of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            v = pages.matrix(batch.column("v"), width)
            low, high = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("low", "high"))
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            x = v.astype(np.float64)
            scale = np.sqrt((x * x).sum(1) * max(longest, 1))
            open_, upper = tree.reached(units(v, longest, True), scale, low, high)
            if first is not None and upper.shape[1] > first:
                order = np.argsort(np.where(open_, -upper, np.inf), axis=1, kind="stable")
                taken = np.zeros(open_.shape, bool)
                np.put_along_axis(taken, order[:, :first], True, axis=1)
                open_ &= taken
            return ids, labels, v, low, high, open_
        return of

    def visits(self, anchors: DataFrame, first: int | None) -> DataFrame:
        """leaf and asked: how many anchors have to look at each lowest node, batch by batch."""
        reaching = self._reaching(first)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            asked = reaching(batch)[-1].sum(axis=0).astype(np.int32)
            leaf = np.flatnonzero(asked).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(asked[leaf])], ["leaf", "asked"])
        return common.arrow_pass(anchors.select("vec_id", "label", "v", "low", "high"),
                                 "leaf int, asked int", each)

    def sent(self, anchors: DataFrame, first: int | None) -> DataFrame:
        """Packed anchors for every group in which they have to look at a node, each once, with the
        nodes as bits."""
        reaching, groups = self._reaching(first), self.nodes
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 6)
        names = [c.split()[0] for c in _SENT.split(", ")]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in common.small(batches):
                ids, labels, v, low, high, open_ = reaching(batch)
                made, size = [], 0
                for g, leaves in groups.items():
                    mine = open_[:, leaves]
                    who = np.flatnonzero(mine.any(axis=1))
                    if not len(who):
                        continue
                    made.append((g, len(who), ids[who].tobytes(), labels[who].tobytes(),
                                 _packed(v[who]), low[who].tobytes(), high[who].tobytes(),
                                 np.packbits(mine[who], axis=1).tobytes()))
                    size += sum(map(len, made[-1][2:]))
                    if size > _SENT_BYTES:
                        yield packed(made)
                        made, size = [], 0
                if made:
                    yield packed(made)
        return anchors.select("vec_id", "label", "v", "low", "high").mapInArrow(run, _SENT)

    def _grouped(self) -> DataFrame:
        """The pages and their groups; those of a node with several groups are dealt to them."""
        rows = [(leaf, *g) for leaf, g in self.groups.items()]
        start = self.spark.createDataFrame(pa.table(
            [pa.array(c, pa.int32()) for c in zip(*rows)], ["leaf", "start", "span"]))
        at = F.col("start") + F.pmod(F.xxhash64("page"), F.col("span")).cast("int")
        return (self.stored.select("page", "leaf", "ids", "labels", "vectors")
                .join(F.broadcast(start), "leaf").withColumn("grp", at).drop("start", "span", "page"))

    def _scanned(self, anchors: DataFrame, k: int, same: bool, first: int | None) -> DataFrame:
        width, groups = self.width, self.nodes
        columns = ("grp", "leaf", "ids", "labels", "vectors", "asked", "a_ids", "a_labels",
                   "a_vectors", "low", "high", "nodes")

        def scan(batches) -> Iterator[pa.RecordBatch]:
            out: list[np.ndarray] = []
            size = 0
            for g, rows in groupby(common.rows_of(batches, columns, 16), key=lambda r: r[0]):
                place = {leaf: i for i, leaf in enumerate(groups[g].tolist())}
                held: list[tuple] = []
                for _, leaf, ids, labels, v, n, own, own_labels, q, low, high, nodes in rows:
                    if ids is not None:
                        ids, labels = (np.frombuffer(x, np.int64) for x in (ids, labels))
                        held.append((place[leaf], ids, labels, _unpacked(v, len(ids), width)))
                        continue
                    own, own_labels = np.frombuffer(own, np.int64), np.frombuffer(own_labels, np.int64)
                    low, high = (np.frombuffer(x, np.int64).reshape(n, -1) for x in (low, high))
                    q = _unpacked(q, n, width).astype(np.int64)
                    nodes = np.unpackbits(np.frombuffer(nodes, np.uint8).reshape(n, -1), axis=1,
                                          count=len(place)).astype(bool)
                    best, most = _Best(k, low, high), high.max(axis=1)
                    for at, ids, labels, v in held:
                        who = np.flatnonzero(nodes[:, at])
                        if not len(who):
                            continue
                        got = exact_scores(q[who], v.astype(np.int64))
                        i, j = np.nonzero((got >= best.low[who].min(axis=1)[:, None])
                                          & (got <= most[who][:, None]))
                        scores, i = got[i, j], who[i]
                        fit = ((own_labels[i] == labels[j]) == same) & (own[i] != ids[j])
                        best.add(i[fit], ids[j[fit]], scores[fit])
                    for part in best.found(own):
                        out.append(part)
                        size += len(part)
                    if size > 50_000:
                        yield _found(out)
                        out, size = [], 0
            if out:
                yield _found(out)

        # More tasks than groups, so that few tasks get several of them.
        both = common.beside(self._grouped(), self.sent(anchors, first),
                             max(pages.partitions(self.spark), 2 * len(self.nodes)), ["grp"])
        return both.select(*columns).mapInArrow(scan, _FOUND)

    @staticmethod
    def _ranked(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "vec_id")
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("anchor", "nth", "rank", "vec_id", "score"))


def _found(parts: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(parts)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[:, 0]), pa.array(rows[:, 1].astype(np.int32)), pa.array(rows[:, 2]),
         pa.array(rows[:, 3])], ["anchor", "nth", "vec_id", "score"])


def _grouping(tree: CoverTree, size: dict[int, int], many: int) -> dict[int, tuple[int, int]]:
    """First group and number of groups of each lowest node: ``many`` groups of about equal ``size``
    (bytes by node), of nodes that are neighbours in the tree."""
    leaves = np.array([n for n in np.lexsort(tree.path[::-1]).tolist() if n in size], np.int64)
    share = np.array([size[n] for n in leaves.tolist()], np.float64)
    share *= many / share.sum()
    start = np.minimum(np.cumsum(share) - share, many - 1).astype(np.int64)
    span = np.clip(np.rint(share).astype(np.int64), 1, many - start)
    return {n: (s, w) for n, s, w in zip(leaves.tolist(), start.tolist(), span.tolist())}


def build(points: DataFrame, most: int, sample: int = 4096, page: int = 1024,
          group: int = 32 << 20) -> Index | None:
    """The index of rows (vec_id, label, v), of which at most ``most`` are asked for at once.

    The tree's sample is the square root of the number of rows, ``sample`` at most. ``group``: bytes
    of packed vectors that a task holds.
    """
    spark = points.sparkSession
    copies = Window.partitionBy("label", "v").orderBy("vec_id")
    rows = common.written(points.withColumn("copy", F.row_number().over(copies))
                          .where(F.col("copy") <= most + 1).select("vec_id", "label", "v"), "candidates")
    squares = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    facts = rows.agg(F.max(squares).alias("longest"), F.max(F.size("v")).alias("width"),
                     F.count(F.lit(1)).alias("n")).first()
    if not facts.n:
        return None
    longest, width = facts.longest, max(facts.width, 1)
    size = min(sample, math.ceil(math.sqrt(facts.n)))
    drawn = pages.drawn(rows, "vec_id", size, facts.n).select("v").collect() or rows.select("v").take(1)
    padded = np.array([list(r.v) + [0] * (width - len(r.v)) for r in drawn], np.int64)
    tree = CoverTree(np.unique(units(padded, longest, False), axis=0))

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf, far = tree.below(units(pages.matrix(batch.column("v"), width), longest, False))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(far[:, -1]),
             pa.array(list(far), pa.list_(pa.float64()))], ["vec_id", "label", "v", "leaf", "d", "far"])

    def pack(table: pa.Table) -> dict:
        table = table.combine_chunks()
        far = np.array(table.column("far").to_pylist())
        return {"leaf": table.column("leaf")[0].as_py(), "n": table.num_rows,
                "ids": table.column("vec_id").to_numpy().tobytes(),
                "labels": table.column("label").to_numpy().tobytes(),
                "vectors": _packed(pages.matrix(table.column("v").chunk(0), width)),
                "far": far.max(axis=0).tolist()}

    made = common.arrow_pass(rows, "vec_id long, label long, v array<long>, leaf int, d double, "
                             "far array<double>", placed)
    stored = common.written(pages.paged(made, ["leaf"], ["d", "vec_id"], page,
                                        pages.partitions(spark), pack, _PAGE), "cover-tree-pages")
    levels = len(tree.level)   # one row a lowest node: as many as the sample at most
    nodes = stored.groupBy("leaf").agg(
        F.count(F.lit(1)), F.sum(F.length("vectors")),
        *[F.max(F.col("far")[i]).alias(f"r{i}") for i in range(levels)]).collect()
    tree.measured({r[0]: np.array(r[3:]) for r in nodes})
    size, count = sum(r[2] for r in nodes), sum(r[1] for r in nodes)
    many = max(math.ceil(size / group),   # small tables: some groups a core, none too small
               min(count, 4 * spark.sparkContext.defaultParallelism, math.ceil(128 * size / group)))
    return Index(spark, tree, stored, longest, width,
                 _grouping(tree, {r[0]: r[2] for r in nodes}, many))


def mine(table: DataFrame, is_anchor: Column, label: Column, vector: str = "embedding",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, **tree) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best rows of the same label; for each, the best rows of other
    labels whose score is ``low`` to ``high`` per cent of the positive's.
    """
    spark = table.sparkSession
    out = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")
    plain = table.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                         F.col(vector).cast("array<double>").alias("v"),
                         F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    known = (plain.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & pages.usable("v"))
             .withColumn("v", F.transform("v", lambda x: F.floor(256 * x))))
    points = (known.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"),
                                          F.bool_or("anchor").alias("anchor"))
              .select("vec_id", "row.label", "row.v", "anchor"))
    points = common.written(points, "points")
    index = build(points.drop("anchor"), max(positives, negatives), **tree)
    if index is None:
        return spark.createDataFrame([], out)
    anchors = points.where("anchor").drop("anchor")
    whole = lambda limit: F.array(F.lit(limit).cast("long"))
    best = common.written(index.search(
        anchors.withColumns({"low": whole(-NO_LIMIT), "high": whole(NO_LIMIT)}), positives, True)
        .select("anchor", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score")), "positives")
    # One window a positive, in the order of ranks; windows not used are empty.
    window = best.groupBy(F.col("anchor").alias("vec_id")).agg(F.map_from_entries(
        F.collect_list(F.struct("nth", "positive_score"))).alias("scores"))

    def limits(share: int, up: bool, empty: int) -> Column:
        def one(i: Column) -> Column:
            at = F.col("scores")[i] * share
            whole_ = at - F.pmod(at, F.lit(100))       # a multiple of 100, rounded down
            if up:
                whole_ = F.when(F.pmod(at, F.lit(100)) > 0, whole_ + 100).otherwise(whole_)
            return F.coalesce((whole_ / 100).cast("long"), F.lit(empty).cast("long"))
        return F.transform(F.sequence(F.lit(1), F.lit(positives)), one)

    windowed = anchors.join(window.hint("merge"), "vec_id").withColumns(
        {"low": limits(low, True, NO_LIMIT), "high": limits(high, False, -NO_LIMIT)}).drop("scores")
    found = index.search(common.written(windowed, "windows"), negatives, False)
    return (found.withColumn("nth", F.col("nth") + 1).join(best.hint("merge"), ["anchor", "nth"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank",
                    F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
