"""Best-fit packing of token sequences by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. Which lengths share a bin is planned on
the histogram of piece lengths (at most ``capacity`` numbers, whatever the corpus): a bin starts
with the longest length left, a bitset subset-sum over the lengths left finds the fullest bin
that holds it, and that combination is taken out as often as the counts allow. The plan is a short
list of patterns. Pieces are numbered within their length (per task, then by a running sum over
tasks) and take the places of the patterns in that order.

Null text is the empty text: one piece, its end token. Repeated rows and null ids are packed
as rows of their own. An empty table gives an empty table. Other columns are left out.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .bpe import _Units, byte_alphabet

#: How word pieces are split before the merges (a fixed value of this vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Units an encoder keeps of each kind. Frequent ones are soon back in an emptied cache: seven times
#: as many took 65 MB more of each worker, and no less time.
CACHE_UNITS = 50_000


class ByteEncoder:
    """Ids of a byte-level vocabulary, special strings in a text included.

    Word pieces never reach over a single space from its left, so the parts between single
    spaces are encoded once and remembered; texts with runs of white space are split by the
    full pattern.
    """

    RUNS = re.compile(r" \s")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.specials}
        self._encoding = tiktoken.Encoding("read", pat_str=SPLIT, mergeable_ranks=ranks,
                                           special_tokens={})
        self.first = _Units(self._ids, CACHE_UNITS)
        self.units = _Units(lambda unit: self._ids(" " + unit), CACHE_UNITS)

    def _ids(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(text)

    def _plain(self, text: str) -> bytes:
        if self.RUNS.search(text):
            return np.asarray(self._ids(text), np.int32).tobytes()
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.units.__getitem__, rest))

    def plain(self, text: str) -> bytes:
        """Packed ids of a text in which special strings are text as any other."""
        return self._plain(text) if text else b""

    def encode(self, text: str | None) -> bytes:
        """Ids as packed little-endian 32-bit numbers."""
        if not text:
            return b""
        if "<|" not in text:
            return self._plain(text)
        return b"".join(np.int32(self.specials[p]).tobytes() if p in self.specials
                        else self._plain(p) for p in self.special_pattern.split(text))


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


_PIECES = ("doc_id long, piece int, start long, length int, ids_crc32 long, task int, "
           "nth long")


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece; ``nth`` counts the pieces of a length within a task.

    A document longer than ``capacity`` is cut so that only its first piece is shorter.
    """
    def run(batches):
        encoder, task = byte_encoder(path), TaskContext.get().partitionId()
        end = np.int32(end_id).tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in common.small(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist()):
                ids = encoder.encode(text) + end
                n = len(ids) // 4
                at, size = 0, (n - 1) % capacity + 1
                for piece in range(-(-n // capacity)):
                    out.append((doc_id, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]),
                                task, int(seen[size])))
                    seen[size] += 1
                    at, size = at + size, capacity
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(),
                        pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
    return common.texts(docs).mapInArrow(run, _PIECES)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each at most as often as counted, whose sum is as near to ``room`` as can be.

    Bit s of the set says that sum s can be made; a copy of the set before each length leads back
    from the best sum. Longer lengths come first, and counts beyond what fits are not tried.
    """
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        copies, share = min(counts[length], room // length), 1
        while copies > 0:   # 1, 2, 4, … copies make every number of copies
            take = min(share, copies)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            copies, share = copies - take, share * 2
            if sums >> room & 1:
                break
        if sums >> room & 1:
            break
    best, chosen = sums.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen += [length] * take
            best -= length * take
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(how many bins, the lengths in each) until no length is left."""
    left = {n: c for n, c in histogram.items() if c > 0}
    patterns = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = [longest, *fullest({n: c for n, c in left.items() if c}, capacity - longest)]
        left[longest] += 1
        uses = {n: chosen.count(n) for n in set(chosen)}
        times = min(left[n] // k for n, k in uses.items())
        patterns.append((times, chosen))
        for n, k in uses.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return patterns


def places(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank from, rank to, first bin, per bin, offset) of every length in every pattern."""
    out, given, bins = [], {}, 0
    for times, lengths in patterns:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            k = lengths.count(n)
            at = given.get(n, 0)
            out.append((n, at, at + times * k, bins, k, offset))
            given[n] = at + times * k
            offset += k * n
        bins += times
    return out


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    cut = common.written(pieces(docs, path, end_id, capacity), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    base = per_task.select("length", "task",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
                 .collect()}   # at most `capacity` rows
    slots = places(plan(histogram, capacity))
    slot = spark.createDataFrame(slots or [(0, 0, 0, 0, 1, 0)], (
        "length int, low long, high long, bin long, each long, at long"))
    # The plan has at most a few patterns per length, so its places are few whatever the corpus.
    rank = F.col("nth") + F.col("base")
    placed = (common.with_side(cut.join(base, ["length", "task"]).withColumn("rank", rank),
                               slot.withColumnRenamed("length", "slot_length"),
                               (F.col("length") == F.col("slot_length"))
                               & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
                               "inner", len(slots)))
    turn = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("bin") + F.floor(turn / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (turn % F.col("each")) * F.col("length")).cast("long").alias("offset"))
