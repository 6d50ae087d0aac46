"""Token counts with overlap resynchronisation for huge documents.

A text up to ``chunk`` characters is encoded as a whole. A longer one is cut into chunks that
reach ``overlap`` characters into their neighbours; the chunks spread over the cluster and each
is encoded with offsets. Two neighbours are spliced at a token that both made, with the same begin
and end, in their shared stretch. That is proof enough: the merges give exactly the sequence whose
neighbouring tokens are all stable as pairs, and left of that token, from it to its right
neighbour, and further on, every pair of neighbours stands in one of the two encodings. Where no
such token exists the document's overlaps are widened fourfold and its chunks encoded
again, until a chunk would reach over a whole neighbour; then the text is encoded as a whole.

Null text is empty: no bytes, no tokens. Repeated rows are counted row by row, null ids are kept,
an empty table gives an empty table, other columns are left out. Texts are never cut short.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

_COUNTED = "doc_id long, n_bytes long, n_tokens long"
_EDGE = np.dtype([("begin", "<i8"), ("end", "<i8"), ("nth", "<i8")])


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _whole(docs: DataFrame, path: str) -> DataFrame:
    """Counts of texts that are encoded in one go."""
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        ids = processor(path).encode(texts, num_threads=1, return_type="numpy")
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
             pa.array([len(i) for i in ids], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return common.arrow_pass(docs.select("doc_id", "text"), _COUNTED, each)


def windows(n: int, chunk: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(own from, own to, read from, read to) of each chunk of a text of n characters."""
    cuts = [*range(0, max(n - chunk // 2, 1), chunk), n]
    return [(a, b, max(0, a - overlap), min(n, b + overlap)) for a, b in zip(cuts, cuts[1:])]


def byte_bounds(text: str, own: tuple[int, int, int, int], overlap: int) -> tuple[int, int, int]:
    """Where the chunk is read from, where the stretch shared with the chunk before it ends and
    where that shared with the next one begins, in bytes of the text."""
    own_from, own_to, read_from, read_to = own
    begin = len(text[:read_from].encode())
    return (begin, begin + len(text[read_from:min(own_from + overlap, read_to)].encode()),
            begin + len(text[read_from:max(own_to - overlap, read_from)].encode()))


def edges(sp, text: str, begin: int, head_to: int, tail_from: int) -> tuple[int, bytes, bytes]:
    """Tokens of a chunk, and those that lie in the stretch shared with either neighbour."""
    made = sp.encode(text, return_type="proto").pieces
    rows = np.zeros(len(made), _EDGE)
    rows["begin"] = [p.begin for p in made]
    rows["end"] = [p.end for p in made]
    rows["begin"] += begin
    rows["end"] += begin
    rows["nth"] = np.arange(len(rows))
    return (len(rows), rows[rows["end"] <= head_to].tobytes(),
            rows[rows["begin"] >= tail_from].tobytes())


def spliced(n_tokens: list[int], heads: list[bytes], tails: list[bytes]) -> int | None:
    """Tokens of the whole text, or None where two neighbours have no token in common.

    Byte tokens of one character share its span or have an empty one; only spans that occur
    once on both sides are trusted.
    """
    total, at = 0, 0
    for n, tail, head in zip(n_tokens, tails, heads[1:]):
        left, right = np.frombuffer(tail, _EDGE), np.frombuffer(head, _EDGE)
        found: dict[tuple[int, int], list[int]] = {}
        for side, rows in enumerate((left, right)):
            for begin, end, nth in rows.tolist():
                found.setdefault((begin, end), [[], []])[side].append(nth)
        both = [(span, sides) for span, sides in found.items()
                if span[1] > span[0] and len(sides[0]) == len(sides[1]) == 1
                and sides[0][0] >= at]
        if not both:
            return None
        # The middle one: furthest from where either chunk was cut.
        middle = sorted(both)[len(both) // 2][1]
        total += middle[0][0] - at
        at = middle[1][0]
    return total + n_tokens[-1] - at


def _chunked(docs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """doc_id, row, n_bytes, n_tokens; n_tokens is null where the chunks don't splice."""
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc_id, row, text in zip(*(batch.column(c).to_pylist()
                                       for c in ("doc_id", "row", "text"))):
            n_bytes = len(text.encode())
            for nth, own in enumerate(windows(len(text), chunk, overlap)):
                out.append((doc_id, row, n_bytes, nth, *byte_bounds(text, own, overlap),
                            text[own[2]:own[3]]))
        return pa.RecordBatch.from_pylist([dict(zip(_CUT, o)) for o in out], _CUT_ARROW)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sp, out = processor(path), []
        for r in batch.to_pylist():
            n, head, tail = edges(sp, r["text"], r["begin"], r["head_to"], r["tail_from"])
            out.append({"doc_id": r["doc_id"], "row": r["row"], "n_bytes": r["n_bytes"],
                        "nth": r["nth"], "n": n, "head": head, "tail": tail})
        return pa.RecordBatch.from_pylist(out, pa.schema(
            [("doc_id", pa.int64()), ("row", pa.string()), ("n_bytes", pa.int64()),
             ("nth", pa.int64()), ("n", pa.int64()), ("head", pa.binary()),
             ("tail", pa.binary())]))

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("nth")
        n = spliced(*(table.column(c).to_pylist() for c in ("n", "head", "tail")))
        return pa.table({"doc_id": table.column("doc_id")[:1], "row": table.column("row")[:1],
                         "n_bytes": table.column("n_bytes")[:1],
                         "n_tokens": pa.array([n], pa.int64())})

    parts = common.arrow_pass(docs.select("doc_id", "row", "text"), _CUT_SQL, cut)
    # A huge text is spread by its chunks; what meets again per text are the edges only.
    spread = parts.repartition("row", "nth")
    return (common.arrow_pass(spread, "doc_id long, row string, n_bytes long, nth long, n long, "
                              "head binary, tail binary", run)
            .groupBy("row").applyInArrow(join, "doc_id long, row string, n_bytes long, "
                                         "n_tokens long"))


_CUT = ["doc_id", "row", "n_bytes", "nth", "begin", "head_to", "tail_from", "text"]
_CUT_SQL = ", ".join(f"{c} {'string' if c in ('row', 'text') else 'long'}" for c in _CUT)
_CUT_ARROW = pa.schema([(c, pa.string() if c in ("row", "text") else pa.int64()) for c in _CUT])


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, chunk: int = 32_768,
                 overlap: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""
    rows = common.texts(docs)
    long = F.length("text") > chunk
    counted = _whole(rows.where(~F.coalesce(long, F.lit(False))), path)
    # Rows are told apart by their own number, as ids may repeat or be null.
    open_ = common.written(rows.where(long).withColumn("row", F.expr("uuid()")), "long-texts")
    left = open_.count()
    while left:
        if 2 * overlap >= chunk:
            counted = counted.unionByName(_whole(open_, path))
            break
        tried = common.written(_chunked(open_, path, chunk, overlap), "spliced")
        done = tried.where(F.col("n_tokens").isNotNull())
        counted = counted.unionByName(done.drop("row"))
        failed = tried.where(F.col("n_tokens").isNull()).select("row")
        left = failed.count()
        if left:
            open_ = common.with_side(open_, failed, "row", "left_semi", left)
            overlap *= 4
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
