"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into halves with a codebook each; the two nearest codewords name a cell of
the product grid, per label. Each vector visits other cells in order of their distance, as a
multi-sequence walk over the two sorted codeword lists. A half that is nearer to codeword a lies at
least (|u - c|^2 - |u - a|^2) / (2 |c - a|) from the border to codeword c, so the squared sums of
both halves bound the distance of anything in a cell. With ``target_recall`` 1 the walk ends where
that bound passes the link distance, sqrt(2 - 2 cos): no link is lost. A lower target ends it where
the share of a bounded sample's true links that lie nearer reaches the target.

The codebooks grow with the table, so that a cell holds about ``per_cell`` vectors of a label at any
size. A row of the grid (one left codeword) is stored as pages sorted by cell. A vector is sent once
to each row it reaches, packed with others, and there verified, by cosine in double precision, with
the cells it reaches only; of two cells the vectors of the earlier one are sent. Equal vectors of a
label are one row with a count until the end, so copies are never paired. Verification gives per
vector how many it links to, and for connectivity a star per linked group, not all pairs.

A vector that is null or zero, holds null or non-finite numbers, or whose label is null links with
nothing. Repeated rows are vectors of their own that link with each other. Vectors of different
lengths: the shorter is filled up with zeros. Rows with a null vec_id are left out, as they can't be
named. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, pages
from .components import components

_PAGE = "label long, row int, n int, ids binary, copies binary, columns binary, vectors binary"


def walk(left: np.ndarray, right: np.ndarray, until: float):
    """Cells (i, j) in order of left[i] + right[j], both sorted, while that is at most ``until``."""
    heap, seen = [(left[0] + right[0], 0, 0)], {(0, 0)}
    while heap and heap[0][0] <= until:
        total, i, j = heapq.heappop(heap)
        yield i, j, total
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(left) and b < len(right) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (left[a] + right[b], a, b))


def reached(l2: np.ndarray, r2: np.ndarray, until: float) -> list[tuple[int, list[int]]]:
    """Rows of the grid that the walk of one vector meets, nearest first, and the columns met there."""
    by_l, by_r = np.argsort(l2, kind="stable"), np.argsort(r2, kind="stable")
    met: dict[int, list[int]] = {}
    for a, b, _ in walk(l2[by_l], r2[by_r], until):
        met.setdefault(int(by_l[a]), []).append(int(by_r[b]))
    return list(met.items())


def border_squares(half: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per row and codeword: square of the least distance to that codeword's region."""
    d2 = pages.squared_distances(half, book)
    own = d2.argmin(axis=1)
    between = np.sqrt(pages.squared_distances(book, book))[own]
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(between > 0, (d2 - d2[np.arange(len(half)), own][:, None])
                       / (2 * between), 0.0)
    return np.maximum(out, 0) ** 2


def unit(v: np.ndarray) -> np.ndarray:
    top = np.abs(v).max(axis=1, keepdims=True)
    scaled = v / top   # keeps squares in range
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def local_groups(linked: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> list[tuple[int, int]]:
    """(id, smallest id of its group) in the graph between two pages."""
    far = np.iinfo(np.int64).max
    some_a, some_b = linked.any(axis=1), linked.any(axis=0)
    sub = linked[np.ix_(some_a, some_b)]
    a, b = a_ids[some_a].copy(), b_ids[some_b].copy()
    while len(a):
        new_b = np.minimum(b, np.where(sub, a[:, None], far).min(axis=0))
        new_a = np.minimum(a, np.where(sub, new_b[None], far).min(axis=1))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    pairs = {*zip(a_ids[some_a].tolist(), a.tolist()), *zip(b_ids[some_b].tolist(), b.tolist())}
    return [(x, y) for x, y in pairs if x != y]


def link(table: DataFrame, cosine: float = 0.98, vector: str = "embedding", label: str = "label",
         sample: int = 8192, per_cell: int = 16, page: int = 4096, target_recall: float = 1.0
         ) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    The codebooks come from ``sample`` vectors, or eight a codeword where that is more, 65,536 at most.
    """
    spark = table.sparkSession
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.col(label).cast("long").alias("label"),
                        F.col(vector).cast("array<double>").alias("v")).where("vec_id IS NOT NULL")
    fit = (F.col("label").isNotNull() & pages.usable("v")
           & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    keyed = rows.withColumn("fit", F.coalesce(fit, F.lit(False))).withColumns(
        {"h1": F.when(F.col("fit"), F.xxhash64("label", "v")),
         "h2": F.when(F.col("fit"), F.xxhash64("v", F.lit("second"), "label"))})
    # Equal vectors of a label: one row, the smallest id, with its number of copies.
    distinct = common.written(
        keyed.where("fit").groupBy("label", "h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
             F.min_by("v", "vec_id").alias("v")).sortWithinPartitions("label"), "distinct-vectors")
    found = common.written(verified(distinct, cosine, sample, per_cell, page, target_recall), "vector-links")
    links = found.where("n > 0").groupBy("rep").agg(F.sum("n").alias("others"))
    groups = components(found.where("to IS NOT NULL"), "rep", "to")
    result = (distinct.select("label", "h1", "h2", "rep", "copies")
              .join(links, "rep", "left")
              .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
              .select("h1", "h2", F.col("label").alias("of_label"),
                      (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    same = ((keyed.h1 == result.h1) & (keyed.h2 == result.h2) & (keyed.label == result.of_label))
    joined = keyed.drop("v").join(result, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def verified(distinct: DataFrame, cosine: float, sample: int, per_cell: int, page: int,
             target_recall: float) -> DataFrame:
    """rep, n, to, looked: vectors with the number of others linked, links by which groups hang
    together, and (rep null) how many pairs were compared; of rows label, rep, copies, v."""
    spark = distinct.sparkSession
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"),
                         F.count_distinct("label").alias("labels")).first()
    width = max(facts.width or 0, 2)
    half = width // 2
    # As many codewords per half as give about per_cell vectors to a cell of an average label.
    words = max(1, round((facts.n / max(1, facts.labels) / per_cell) ** 0.5))
    size = min(max(sample, 8 * words), 65_536)
    drawn = pages.drawn(distinct, "rep", size, facts.n).select("v", "label").collect()
    if drawn:
        x = unit(np.array([list(r.v) + [0.0] * (width - len(r.v)) for r in drawn]))
        left, right = pages.kmeans(x[:, :half], words), pages.kmeans(x[:, half:], words)
        until = 2 - 2 * cosine
        if target_recall < 1:
            until = min(until, _recall_bound(x, np.array([r.label for r in drawn]), left, right,
                                             cosine, target_recall))
    else:
        left = right = np.zeros((1, half))
        until = 0.0
    until = until * (1 + 1e-9) + 1e-9   # rounding must not lose a link

    def cells(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors, their rows and columns of the grid, and the squared distances to both."""
        u = unit(v)
        l2, r2 = pages.squared_distances(u[:, :half], left), pages.squared_distances(u[:, half:], right)
        return u, l2.argmin(axis=1), r2.argmin(axis=1), l2, r2

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, i, j, l2, r2 = cells(pages.matrix(batch.column("v"), width))
        return pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
             batch.column("rep"), batch.column("copies"), batch.column("v")],
            ["label", "row", "column", "rep", "copies", "v"])

    def pack(t: pa.Table) -> dict:
        t = t.combine_chunks()
        return {"label": t.column("label")[0].as_py(), "row": t.column("row")[0].as_py(),
                "n": t.num_rows, "ids": t.column("rep").to_numpy().tobytes(),
                "copies": t.column("copies").to_numpy().tobytes(),
                "columns": t.column("column").to_numpy().tobytes(),
                "vectors": pages.matrix(t.column("v").chunk(0), width).tobytes()}

    kept = distinct.select("label", "rep", "copies", "v")
    grid = common.arrow_pass(kept, "label long, row int, column int, rep long, copies long, v array<double>",
                             placed)
    book = common.written(pages.paged(grid, ["label", "row"], ["column", "rep"], page,
                                      pages.partitions(spark), pack, _PAGE), "vector-pages")

    def sent(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Vectors packed for each row of their label's grid that they reach; of two cells those of
        the earlier one go, so each pair of vectors meets once."""
        v = pages.matrix(batch.column("v"), width)
        u, i, j, _, _ = cells(v)
        l2, r2 = border_squares(u[:, :half], left), border_squares(u[:, half:], right)
        labels, ids, copies = (batch.column(c).to_numpy() for c in ("label", "rep", "copies"))
        asked: dict[tuple[int, int], list[tuple[int, list[int]]]] = {}
        for k in range(len(v)):
            for row, columns in reached(l2[k], r2[k], until):
                if row < i[k]:
                    continue
                if row == i[k]:
                    columns = [c for c in columns if c >= j[k]]
                if columns:
                    asked.setdefault((int(labels[k]), row), []).append((k, columns))
        out = []
        for (label, row), who in asked.items():
            at = np.array([k for k, _ in who])
            ends = np.cumsum([len(c) for _, c in who]).astype(np.int32)
            out.append((label, row, ids[at].tobytes(), copies[at].tobytes(),
                        np.where(i[at] == row, j[at], -1).astype(np.int32).tobytes(), v[at].tobytes(),
                        ends.tobytes(), np.concatenate([c for _, c in who]).astype(np.int32).tobytes()))
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 6)
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                                          ["label", "row", *_SENT])

    asked = (common.arrow_pass(kept, "label long, row int, " + ", ".join(f"{c} binary" for c in _SENT), sent)
             .join(book.select("page", "label", "row"), ["label", "row"]).drop("label", "row"))
    stored = book.select("page", "ids", "copies", "columns", "vectors")
    columns = ("page", "ids", "copies", "columns", "vectors", *_SENT)

    def verify(batches):
        for _, rows in groupby(common.rows_of(batches, columns), key=lambda r: r[0]):
            made, looked = [], 0
            for _, *mine, o_ids, o_copies, o_own, o_vectors, o_ends, o_columns in rows:
                if mine[0] is not None:
                    b_ids, b_n = (np.frombuffer(m, np.int64) for m in mine[:2])
                    column = np.frombuffer(mine[2], np.int32)
                    begins = np.searchsorted(column, np.arange(len(right) + 1))   # sorted by column
                    b = unit(np.frombuffer(mine[3], np.float64).reshape(-1, width))
                    continue
                a_ids, a_n = np.frombuffer(o_ids, np.int64), np.frombuffer(o_copies, np.int64)
                a = unit(np.frombuffer(o_vectors, np.float64).reshape(-1, width))
                own = np.frombuffer(o_own, np.int32)
                ends, met = np.frombuffer(o_ends, np.int32), np.frombuffer(o_columns, np.int32)
                who = np.repeat(np.arange(len(a)), np.diff(ends, prepend=0))
                linked = np.zeros((len(a), len(b)), bool)
                order = np.argsort(met, kind="stable")
                cuts = np.flatnonzero(np.diff(met[order])) + 1
                for part in np.split(order, cuts):
                    c = met[part[0]] if len(part) else 0
                    low, high = begins[c], begins[c + 1]
                    if high > low and len(part):
                        some = who[part]
                        near = a[some] @ b[low:high].T >= cosine
                        # Inside one cell the smaller id looks at the larger.
                        inside = own[some] == c
                        near &= ~inside[:, None] | (a_ids[some][:, None] < b_ids[None, low:high])
                        linked[some, low:high] = near
                        looked += near.size
                if linked.any():
                    for ids, n in ((a_ids, linked @ b_n), (b_ids, a_n @ linked)):
                        made += [(x, y, None, None) for x, y in zip(ids[n > 0].tolist(), n[n > 0].tolist())]
                    made += [(x, 0, y, None) for x, y in local_groups(linked, a_ids, b_ids)]
                if len(made) > 50_000:
                    yield _found(made)
                    made = []
            yield _found([*made, (None, 0, None, looked)])

    both = common.beside(stored, asked, pages.partitions(spark), ["page"])
    return both.select(*columns).mapInArrow(verify, "rep long, n long, to long, looked long")


_SENT = ("o_ids", "o_copies", "o_own", "o_vectors", "o_ends", "o_columns")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      ["rep", "n", "to", "looked"])


def _recall_bound(x: np.ndarray, labels: np.ndarray, left: np.ndarray, right: np.ndarray,
                  cosine: float, target: float) -> float:
    """The bound within which ``target`` of the sample's own links lie (all, without links)."""
    half = left.shape[1]
    l2, r2 = border_squares(x[:, :half], left), border_squares(x[:, half:], right)
    i = pages.squared_distances(x[:, :half], left).argmin(axis=1)
    j = pages.squared_distances(x[:, half:], right).argmin(axis=1)
    needed = []
    for begin in range(0, len(x), 512):
        near = (x[begin:begin + 512] @ x.T >= cosine) & (
            labels[begin:begin + 512, None] == labels[None])
        a, b = np.nonzero(near)
        a = a + begin
        a, b = a[a != b], b[a != b]
        needed.append(l2[a, i[b]] + r2[a, j[b]])
    found = np.concatenate(needed)
    return float(np.quantile(found, target, method="higher")) if len(found) else np.inf
