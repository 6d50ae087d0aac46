"""Jaccard similarity join of word n-gram sets: size-aware, heavy and light sets apart.

Two sets with J >= t share at least ceil(t |x|) elements of the smaller requirement, so in any
common order of elements the first |x| - ceil(t |x|) + c of both share c. Elements are ordered
rarest first by a count sketch over all documents (ties by hash; the order changes cost, never
results).

* Light sets (at most ``boundary`` elements) enumerate the 2-element subsets of that prefix
  (c = 2); linked light sets have a subset in common.
* Heavy sets put the prefix (c = 1) into inverted lists; light sets that are within the size ratio
  of a heavy one do so too, and the lists are scanned.
* The boundary has the least cost, summed over the histogram of sizes: subsets enumerated by the
  light ones against list entries made and scanned by the heavy ones.

Lists of up to ``SHORT`` sets give their pairs at once. A longer one is never expanded into all
its pairs: every member is compared with the list's most central member, and then only members of
different components are paired. A pair counts only at a place in the order from which the rest of
both sets still suffices. Equal sets are one set throughout. Bitmaps, whose bits bound the overlap
from above, drop hopeless pairs: first one of a fixed width per set, then, for the sets still asked
for, one as wide as the set is large. The others are verified on whole sets of 64-bit hashes.

A document's set: the distinct n-word shingles of its lower-cased (A-Z) text, words being runs
without ASCII white space; fewer words: the whole sequence as one; no words or null text: empty,
and linked with nothing. Repeated rows have equal sets and are linked. A null doc_id is kept as a
row, links with nothing and is its own (null) component. An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, pages
from .components import components

_MIX = np.uint64(0x9E3779B97F4A7C15)
_HASHED_WORDS = 250_000
#: Sets of a list that is paired at once.
SHORT = 4
_BITS = 2048


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _HASHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_words = _Words()


def _finished(h: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(n, len(w))
    h = w[:len(w) - size + 1].copy()
    for i in range(1, size):
        h *= _MIX
        h += w[i:len(w) - size + 1 + i]
    return np.unique(_finished(h + np.uint64(size)))


def least_overlap(size: np.ndarray | int, percent: int):
    """ceil(t |x|): what a set of that size shares with any partner."""
    return -((-percent * size) // 100)


def signature(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def bitmap(s: np.ndarray, width: int = _BITS) -> bytes:
    """One bit per element, several elements may share one."""
    bits = np.zeros(width, bool)
    bits[(s >> np.uint64(7)).astype(np.int64) % width] = True
    return np.packbits(bits).tobytes()


def wide_bitmap(s: np.ndarray) -> bytes:
    """Four to eight bits per element, a power of two in all, so that wide maps fold."""
    return bitmap(s, max(_BITS, 1 << (4 * len(s) - 1).bit_length()))


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The map that ``words`` numbers would have held."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def could_link(a: bytes, b: bytes, n_a: int, n_b: int, percent: int) -> bool:
    """Every bit that only one set has stands for an element the other lacks."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    x, y = _folded(x, words), _folded(y, words)
    both = min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))
    return 100 * both >= percent * (n_a + n_b - both)


def choose_boundary(histogram: dict[int, int], percent: int, scan: float, most: int = 64) -> int:
    """Size up to which enumerating subsets costs less than lists.

    A light set of size s writes C(p + 1, 2) subsets of its longer prefix, a heavy one writes p
    entries and meets ``scan`` others at each.
    """
    best, boundary, total = 0.0, 0, 0.0
    for s in range(1, most + 1):
        p = s - least_overlap(s, percent) + 1
        total += histogram.get(s, 0) * (math.comb(p + 1, 2) - p * (1 + scan))
        if total <= best:
            best, boundary = total, s
    return boundary


def _arrow(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def _packed(counters: np.ndarray) -> bytes:
    """Compressed, in the smallest type that holds the largest; most counters of a task are small."""
    return zlib.compress(counters.astype(np.min_scalar_type(counters.max())).tobytes(), 1)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    plain = zlib.decompress(raw)
    return np.frombuffer(plain, f"u{len(plain) // n}").astype(np.uint64)


def _counted(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """Per document its set's size and signature, and per task its part of the count sketch, as
    slices of packed counters; rows of both kinds in one pass over the texts."""
    slices = 64

    def run(batches):
        counters = np.zeros(1 << bits, np.uint32)
        for batch in common.small(batches):
            sets = [shingles(t, n) for t in batch.column("text").to_pylist()]
            if not sets:
                continue
            every = np.concatenate(sets)
            counters += np.bincount((every >> np.uint64(64 - bits)).astype(np.int64),
                                    minlength=1 << bits).astype(np.uint32)
            yield _arrow({"doc_id": (batch.column("doc_id"), pa.int64()),
                          "n": ([len(s) for s in sets], pa.int64()),
                          "sig": ([signature(s) for s in sets], pa.int64()),
                          "bits": ([bitmap(s) for s in sets], pa.binary()),
                          "slice": ([None] * len(sets), pa.int32()),
                          "counts": ([None] * len(sets), pa.binary())})
        if counters.any():
            parts = np.split(counters, slices)
            yield _arrow({"doc_id": ([None] * slices, pa.int64()), "n": ([None] * slices, pa.int64()),
                          "sig": ([None] * slices, pa.int64()),
                          "bits": ([None] * slices, pa.binary()),
                          "slice": (list(range(slices)), pa.int32()),
                          "counts": ([_packed(p) for p in parts], pa.binary())})
    return docs.mapInArrow(run, "doc_id long, n long, sig long, bits binary, slice int, "
                           "counts binary")


def _sketch(parts: DataFrame, bits: int) -> np.ndarray:
    """Sum the slices over the tasks; the result has 2**bits counters whatever the corpus."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in common.small(batches):
            for k, raw in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                part = _unpacked(raw, (1 << bits) // 64)
                held[k] = held[k] + part if k in held else part
        for k, total in held.items():
            yield _arrow({"slice": ([k], pa.int32()), "counts": ([total.tobytes()], pa.binary())})
    # Slices are summed as they stream by, whatever the number of tasks they come from.
    sums = parts.repartition(64, "slice").mapInArrow(run, "slice int, counts binary")
    out = np.zeros((64, (1 << bits) // 64), np.uint64)
    for r in sums.collect():   # 64 rows of 2**bits counters in all
        out[r["slice"]] = np.frombuffer(r.counts, np.uint64)
    return out.ravel()


def _ordered(s: np.ndarray, classes: np.ndarray, bits: int) -> np.ndarray:
    """Elements rarest first: class of the estimated count in the top bits, then the hash."""
    cls = classes[(s >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64)
    return np.sort((cls << np.uint64(58)) | ((s * _MIX) >> np.uint64(6)))


def set_entries(s: np.ndarray, ordered: np.ndarray, percent: int, boundary: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """(keys, elements from the first of the key on) under which a set is listed."""
    size = len(s)
    keys, rest = [], []
    spare = size - least_overlap(size, percent)
    if size <= boundary:
        first = ordered[:spare + 2]
        i, j = np.triu_indices(len(first), 1)
        keys.append(_finished(first[i] * _MIX + first[j]) | np.uint64(1))
        rest.append(size - i)
    if size * 100 > percent * boundary:
        keys.append(ordered[:spare + 1] & ~np.uint64(1))
        rest.append(size - np.arange(spare + 1))
    return np.concatenate(keys), np.concatenate(rest)


def signatures(text: Column, words: int = 5) -> Column:
    """struct(sig, n) of a text column, as ``near_duplicates`` has them."""
    @F.pandas_udf("sig long, n long")
    def run(column: pd.Series) -> pd.DataFrame:
        found = [shingles(t if isinstance(t, str) else None, words) for t in column]
        return pd.DataFrame({"sig": [signature(s) for s in found], "n": [len(s) for s in found]},
                            dtype="int64")
    return run(text)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75, id_column: str = "doc_id",
                    text_column: str = "text", sets: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; with ``sets`` also sig, the signature of
    its set, and component, one number for each group (null for empty sets), which tells groups
    apart whose smallest ids are the same.

    ``percent`` is 67 to 100: below, sets of two elements could link, which are listed under no pair.
    """
    if not 67 <= percent <= 100:
        raise ValueError(f"percent is 67 to 100, not {percent}")
    spark = docs.sparkSession
    rows = common.texts(docs, id_column, text_column)
    # Four counters a document, between 2**14 and 2**22: at most 16 MB for any corpus.
    bits = min(22, max(14, math.ceil(math.log2(4 * max(1, docs.count())))))
    counted = common.written(_counted(rows, words, bits), "shingle-counts")
    sizes = counted.where("slice IS NULL").select("doc_id", "n", "sig", "bits")
    sketch = _sketch(counted.where("slice IS NOT NULL").select("slice", "counts"), bits)
    # Only sets of three and more can be linked without being equal (at 75 percent).
    small = sizes.where("n <= 64").groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()
    total = float(sketch.sum())
    often = float((sketch.astype(np.float64) ** 2).sum()) / max(total, 1.0) - total / len(sketch)
    boundary = choose_boundary({r.n: r.c for r in small}, percent, max(often, 0.0) / 8)
    classes = np.minimum(np.log2(np.maximum(sketch, 1)) * 2, 63).astype(np.uint8)
    shared = spark.sparkContext.broadcast(classes.tobytes())   # 2**bits bytes, at most 4 MB

    def entries(batches):
        known = np.frombuffer(shared.value, np.uint8)
        seen: set[int] = set()
        for batch in common.small(batches):
            keys, sigs, ns, rests = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, words)
                if len(s) < 3:
                    continue
                sig = signature(s)
                if sig in seen:   # an equal set of this task is listed already
                    continue
                seen.add(sig)
                key, rest = set_entries(s, _ordered(s, known, bits), percent, boundary)
                keys.append(key.view(np.int64))
                rests.append(rest)
                sigs.append(np.full(len(key), sig))
                ns.append(np.full(len(key), len(s)))
            if keys:
                yield _arrow({"key": (np.concatenate(keys), pa.int64()),
                              "sig": (np.concatenate(sigs), pa.int64()),
                              "n": (np.concatenate(ns).astype(np.int32), pa.int32()),
                              "rest": (np.concatenate(rests).astype(np.int32), pa.int32())})

    def shared_lists(batches):
        """Pairs of short lists, and the entries of longer ones; a task holds its part of the
        entries as packed numbers."""
        held = [[], [], [], []]
        for batch in common.small(batches):
            for h, c in zip(held, ("key", "sig", "n", "rest")):
                h.append(batch.column(c).to_numpy())
        if not held[0]:
            return
        key, sig, n, rest = (np.concatenate(h) for h in held)
        order = np.lexsort((sig, n, key))
        key, sig, n, rest = key[order], sig[order], n[order], rest[order]
        fresh = np.ones(len(key), bool)   # one entry per key and set
        fresh[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
        key, sig, n, rest = key[fresh], sig[fresh], n[fresh], rest[fresh]
        begins = np.ones(len(key) + 1, bool)
        begins[1:-1] = key[1:] != key[:-1]
        # Sorted by size, a set whose neighbours in the list are out of the size ratio has no
        # partner there; in a list of two both must have enough left from this place on.
        fit = ~begins[1:-1] & (100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64))
        lone = begins[:-2] & begins[2:]
        need = -((-percent * (n[:-1].astype(np.int64) + n[1:])) // (100 + percent))
        fit &= ~lone | (np.minimum(rest[:-1], rest[1:]) >= need)
        many = np.zeros(len(key), bool)
        many[:-1] |= fit
        many[1:] |= fit
        key, sig, n, rest = key[many], sig[many], n[many].astype(np.int64), rest[many]
        if not len(key):
            return
        begins = np.ones(len(key), bool)
        begins[1:] = key[1:] != key[:-1]
        length = np.diff(np.append(np.flatnonzero(begins), len(key)))
        short = np.repeat(length <= SHORT, length)
        made = []
        for step in range(1, SHORT):   # a set and the one `step` further on in a short list
            i = np.flatnonzero(short[:-step] & (key[:-step] == key[step:]))
            j = i + step
            need = -((-percent * (n[i] + n[j])) // (100 + percent))
            good = ((100 * n[i] >= percent * n[j]) & (np.minimum(rest[i], rest[j]) >= need))
            x, y = sig[i[good]], sig[j[good]]
            made.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
        pairs = np.unique(np.concatenate(made), axis=0)
        for at in range(0, len(pairs), 50_000):
            part = pairs[at:at + 50_000]
            none = [None] * len(part)
            yield _arrow({"key": (none, pa.int64()), "sig": (part[:, 0], pa.int64()),
                          "n": (none, pa.int32()), "rest": (none, pa.int32()),
                          "other": (part[:, 1], pa.int64())})
        long = np.flatnonzero(~short)
        for at in range(0, len(long), 50_000):
            pick = long[at:at + 50_000]
            yield _arrow({"key": (key[pick], pa.int64()), "sig": (sig[pick], pa.int64()),
                          "n": (n[pick].astype(np.int32), pa.int32()), "rest": (rest[pick], pa.int32()),
                          "other": ([None] * len(pick), pa.int64())})

    listed = "key long, sig long, n int, rest int"
    # About a quarter of all elements is listed; a task gets about half a million entries.
    expected = sizes.agg(F.sum("n")).first()[0] or 0
    parts = max(pages.partitions(spark), math.ceil(expected / 4 / 500_000))
    met = common.written(rows.mapInArrow(entries, listed).repartition(parts, "key")
                         .mapInArrow(shared_lists, listed + ", other long"), "lists")
    lists = met.where("other IS NULL").drop("other")
    short = met.where("other IS NOT NULL").select(F.col("sig").alias("a"), F.col("other").alias("b"))
    # In how many lists a set is; one document stands for each set.
    central = common.written(lists.groupBy("sig", "n").agg(F.count(F.lit(1)).alias("weight")), "central")
    n_sets = central.count()
    named = common.written(sizes.where("doc_id IS NOT NULL").groupBy("sig", "n")
                           .agg(F.min("doc_id").alias("doc_id"), F.min("bits").alias("bits")),
                           "named-sets")

    def unpack(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, words) for t in batch.column("text").to_pylist()]
        made = _arrow({"sig": (batch.column("sig"), pa.int64()),
                       "n": ([len(s) for s in found], pa.int64()),
                       "bits": ([wide_bitmap(s) for s in found], pa.binary()),
                       "elements": ([s.tobytes() for s in found], pa.binary())})
        # an id that repeats may bring another text
        right = [signature(s) == sig for s, sig in zip(found, batch.column("sig").to_pylist())]
        return made.filter(pa.array(right, pa.bool_()))

    def bounded(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = [could_link(x, y, n, m, percent) for x, y, n, m in zip(*(
            batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")))]
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that are linked, by the whole sets of one document for each."""
        def check(batch: pa.RecordBatch) -> pa.RecordBatch:
            a, b = batch.column("a"), batch.column("b")
            good = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            return pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(good, pa.bool_()))
        def hopeful(pairs: DataFrame, marks: DataFrame, label: str) -> DataFrame:
            marked = (pairs.join(marks.toDF("a", "n_a", "bits_a"), "a")
                      .join(marks.toDF("b", "n_b", "bits_b"), "b"))
            return common.written(common.arrow_pass(marked, "a long, b long", bounded), label)

        def ends(pairs: DataFrame) -> DataFrame:
            return pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()

        likely = hopeful(pairs, named.select("sig", "n", "bits"), "hopeful-pairs")
        asked = common.written(ends(likely).join(named.select("sig", "doc_id"), "sig"), "asked-sets")
        sets = common.written(common.arrow_pass(
            common.with_side(rows, asked, "doc_id", "inner", asked.count()).select("sig", "text"),
            "sig long, n long, bits binary, elements binary", unpack), "sets")
        # An id that repeats brings a set once per row.
        wide = sets.groupBy("sig", "n").agg(F.min("bits").alias("bits"))
        likely = hopeful(likely, wide, "likely-pairs")
        wanted = common.written(ends(likely), "wanted-sets")
        whole = common.with_side(sets, wanted, "sig", "left_semi", wanted.count())
        both = (likely.join(whole.select(F.col("sig").alias("a"), F.col("elements").alias("x")), "a")
                .join(whole.select(F.col("sig").alias("b"), F.col("elements").alias("y")), "b"))
        return common.written(common.arrow_pass(both, "a long, b long", check), "links")

    def fits(n1, rest1, n2, rest2):
        """Sizes within the ratio, and enough left from here on in both orders."""
        need = F.ceil(percent * (n1 + n2) / F.lit(100 + percent))
        return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
                & (F.least(rest1, rest2) >= need))

    weighed = common.with_side(lists, central, ["sig", "n"], "inner", n_sets)
    rank = F.struct(-F.col("weight"), F.col("sig"), F.col("n"), F.col("rest"))
    lead = weighed.groupBy("key").agg(F.min(rank).alias("lead")).select(
        "key", F.col("lead.sig").alias("l_sig"), F.col("lead.n").alias("l_n"),
        F.col("lead.rest").alias("l_rest"))
    led = lists.join(lead, "key").where(
        (F.col("sig") != F.col("l_sig"))
        & fits(F.col("n"), F.col("rest"), F.col("l_n"), F.col("l_rest"))).select(
        F.least("sig", "l_sig").alias("a"), F.greatest("sig", "l_sig").alias("b"))
    tried = common.written(short.unionByName(led).distinct(), "first-pairs")
    links = verified(tried)
    groups = common.written(components(links), "groups")
    joined = common.with_side(lists, groups.withColumnRenamed("node", "sig"), "sig", "left",
                              groups.count()).withColumn("component", F.coalesce("component", "sig"))
    mixed = joined.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")
                                      ).where("low <> high").select("key")
    open_ = common.written(joined.join(mixed, "key", "left_semi"), "open-lists")
    left, right = open_.alias("p"), open_.alias("q")
    rest = (left.join(right, F.col("p.key") == F.col("q.key"))
            .where((F.col("p.sig") < F.col("q.sig")) & (F.col("p.component") != F.col("q.component"))
                   & fits(F.col("p.n"), F.col("p.rest"), F.col("q.n"), F.col("q.rest")))
            .select(F.col("p.sig").alias("a"), F.col("q.sig").alias("b")).distinct()
            .join(tried, ["a", "b"], "left_anti"))
    links = links.unionByName(verified(common.written(rest, "other-pairs")))
    groups = components(links)
    # A component's id is the smallest document among all its sets.
    of_set = named.join(groups.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "component", F.coalesce("component", "sig"))
    lowest = of_set.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = common.written(of_set.join(lowest, "component").select(
        "sig", "n", "component_id", "component"), "set-ids")
    joined = sizes.join(ids, ["sig", "n"], "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
        .otherwise(F.col("doc_id")).alias("component_id"),
        *([F.col("sig"), F.when(F.col("n") > 0, F.col("component")).alias("component")] if sets else []))
