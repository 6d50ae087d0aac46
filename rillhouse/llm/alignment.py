"""Alignment of two tokenizers over a corpus, and how often their tokens meet.

Both encode the same bytes: A a space and the text, B the text, before which it puts a space itself.
Laid over each other, the ends of all tokens cut the bytes into segments, and each segment is one
link: the A and the B token that overlap there. Ends that both share cut a document into groups.
A pair of ids counts once for every document that holds it linked.

Pairs are counted by a minimal perfect hash. All distinct pairs are dealt to shards by their A id,
so a shard holds at most its part of all A ids times all B ids, whatever the corpus, and all pairs
of one A id. Over a shard's pairs a perfect hash is built; counts are dense vectors indexed by it,
made per shard and salt and summed in a second step. Pairs that are looked up are verified against
the stored keys. A second pass over the documents aligns them again and looks its pairs up, not
document by document but chunk by chunk: a chunk of documents asks each shard once for its distinct
pairs. Everything that goes through a shuffle is packed arrays; a task holds one chunk, or one
shard's hash and vector, at a time. The tokens of the first pass are kept, so texts are encoded once.

Texts that are null or empty, or whose tokens of either side do not join to the space and the text
(characters that B rewrites, say), have no tokens. Special strings in texts are plain text. Repeated
rows and null ids are rows of their own, repeated documents count each; other columns are left out.
An empty table gives no rows. Texts are whole, of any length.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, pages
from .bpe import byte_alphabet
from .packing import byte_encoder
from .perfect_hash import PerfectHash, mixed
from .token_counts import processor

_CHUNK = "chunk long, ids array<long>, n_a array<int>, n_b array<int>, a binary, b binary"
_COLUMNS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
            "count_sum long, groups string")


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in the smallest type that holds the largest, byte by byte of all numbers, and
    compressed: high bytes and sorted or repeated numbers take next to no room."""
    small = numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))
    planes = small.view(np.uint8).reshape(-1, small.itemsize).T.tobytes()
    return bytes([small.itemsize]) + zstandard.compress(planes, 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{raw[0]}").ravel()


def _kind(most: int) -> np.dtype:
    """The smallest unsigned type for numbers below ``most``."""
    return np.min_scalar_type(max(most - 1, 0))


class Side:
    """Bytes of each token of one tokenizer, as an offset table."""

    def __init__(self, tokens: list[bytes]):
        self.size, self.kind = len(tokens), _kind(len(tokens))
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        until = np.cumsum(lengths)
        at = np.arange(until[-1] if len(until) else 0)
        at += np.repeat(self.begins[ids] - (until - lengths), lengths)
        return self.bytes[at].tobytes()


class Pair:
    """Both tokenizers with their tables, one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        import json
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        special = {t["content"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            tokens[i] = b"" if token in special else bytes(alphabet[c] for c in token)
        self.a = Side(tokens)
        self.encoder, self.sp = byte_encoder(path_a), processor(path_b)
        self.b = Side([self._piece(i) for i in range(self.sp.get_piece_size())])
        self.code = _kind(self.a.size * self.b.size)

    def _piece(self, i: int) -> bytes:
        piece = self.sp.id_to_piece(i)
        if self.sp.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encoded(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides for each text; none where they don't join to the text."""
        given = [t or "" for t in texts]
        pieces = self.sp.encode(given, num_threads=1, return_type="numpy")
        out = []
        for text, b in zip(given, pieces):
            a = np.frombuffer(self.encoder.plain(" " + text), np.int32) if text else _NONE
            b, want = np.asarray(b, np.int32), (" " + text).encode()
            if not text or self.a.joined(a) != want or self.b.joined(b) != want:
                a = b = _NONE
            out.append((a.astype(self.a.kind), b.astype(self.b.kind)))
        return out


_NONE = np.empty(0, np.int32)


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Links:
    """The links of consecutive documents, given their ids one behind the other."""

    def __init__(self, pair: Pair, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        ends_a, ends_b = np.cumsum(pair.a.lengths[a]), np.cumsum(pair.b.lengths[b])
        # No token is empty and both sides of a document end at one byte, so ends tell documents
        # apart too, and each document's last end is a shared one.
        at = np.searchsorted(ends_b, ends_a)
        shared = ends_b[at] == ends_a if len(ends_a) else np.zeros(0, bool)
        ends = np.sort(np.concatenate([ends_a[~shared], ends_b]), kind="stable")
        i, j = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.codes = (a[i].astype(pair.code) * pair.code.type(pair.b.size) + b[j].astype(pair.code))
        until_a, until_b = np.cumsum(n_a), np.cumsum(n_b)
        groups_until = np.concatenate([[0], np.cumsum(shared)])
        self.groups = np.diff(groups_until[np.concatenate([[0], until_a])])
        self.per_doc = n_a.astype(np.int64) + n_b - self.groups
        self.until = np.cumsum(self.per_doc)
        # Places in the written order: of each group first its A, then its B tokens.
        self.last_a = shared
        self.last_b = np.zeros(len(b), bool)
        self.last_b[at[shared]] = True
        group_a = groups_until[:-1]
        b_before = np.concatenate([[0], at[shared] + 1])
        self.place_a = np.arange(len(a)) + b_before[group_a]
        a_through = np.flatnonzero(shared) + 1
        group_b = np.cumsum(self.last_b) - self.last_b
        self.place_b = np.arange(len(b)) + a_through[group_b] if len(b) else np.zeros(0, np.int64)
        self.ends_written = until_a + until_b

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs in order, and in how many of the documents each occurs."""
        bits = max(len(self.per_doc) - 1, 0).bit_length()
        doc = np.repeat(np.arange(len(self.per_doc), dtype=np.uint64), self.per_doc)
        both = np.sort((self.codes.astype(np.uint64) << np.uint64(bits)) | doc)
        fresh = np.ones(len(both), bool)
        fresh[1:] = both[1:] != both[:-1]
        codes = both[fresh] >> np.uint64(bits)
        begins = np.flatnonzero(np.diff(codes, prepend=~codes[:1]))
        return codes[begins].astype(self.codes.dtype), np.diff(begins, append=len(codes))

    def texts(self, a: np.ndarray, b: np.ndarray, shown: list[str]) -> list[str]:
        """The groups of each document as text; ``shown`` has each id with , | and ; behind it."""
        order = np.empty(len(a) + len(b), np.int64)
        order[self.place_a] = a.astype(np.int64) * 3 + self.last_a
        order[self.place_b] = b.astype(np.int64) * 3 + 2 * self.last_b
        words, at, out = list(map(shown.__getitem__, order.tolist())), 0, []
        for until in self.ends_written.tolist():
            out.append("".join(words[at:until])[:-1])
            at = until
        return out


def _chunk(row: tuple, pair: Pair) -> tuple[np.ndarray, ...]:
    n_a, n_b, a, b = row
    return (unpacked(a).astype(pair.a.kind), unpacked(b).astype(pair.b.kind),
            np.array(n_a, np.int64), np.array(n_b, np.int64))


def _codes(raw: bytes, pair: Pair) -> np.ndarray:
    """Sorted codes, which are stored as the steps between them."""
    return np.cumsum(unpacked(raw), dtype=np.uint64).astype(pair.code)


def encoded_chunks(docs: DataFrame, path_a: str, path_b: str, chunk_chars: int = 1_000_000
                   ) -> DataFrame:
    """First pass: the ids of both tokenizers, a chunk of documents in a row."""
    def run(batches):
        pair, task, nth = tokenizers(path_a, path_b), TaskContext.get().partitionId(), 0
        ids, made, chars = [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal nth
            nth += 1
            return pa.RecordBatch.from_arrays([
                pa.array([(task << 33) + nth], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(a) for a, _ in made]], pa.list_(pa.int32())),
                pa.array([[len(b) for _, b in made]], pa.list_(pa.int32())),
                pa.array([packed(np.concatenate([a for a, _ in made]))], pa.binary()),
                pa.array([packed(np.concatenate([b for _, b in made]))], pa.binary())],
                ["chunk", "ids", "n_a", "n_b", "a", "b"])

        for batch in common.small(batches):
            texts = batch.column("text").to_pylist()
            for doc_id, text, both in zip(batch.column("doc_id").to_pylist(), texts,
                                          pair.encoded(texts)):
                ids.append(doc_id)
                made.append(both)
                chars += len(text or "")
                if chars >= chunk_chars or len(ids) >= 65_536:
                    yield closed()
                    ids, made, chars = [], [], 0
        if ids:
            yield closed()
    return common.texts(docs).mapInArrow(run, _CHUNK)


def asked_pairs(chunks: DataFrame, path_a: str, path_b: str, shards: int) -> DataFrame:
    """Per chunk and shard the distinct pairs, in order, and in how many of the chunk's documents
    each occurs."""
    def each(batch: pa.RecordBatch):
        pair, out = tokenizers(path_a, path_b), []
        for chunk, *row in common.rows_of([batch], ("chunk", "n_a", "n_b", "a", "b")):
            links = Links(pair, *_chunk(row, pair))
            codes, counts = links.distinct()
            shard = _shards(codes, pair, shards)
            order = np.lexsort((codes, shard))
            codes, shard, counts = codes[order], shard[order], counts[order]
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for s, c, n in zip(np.split(shard, cuts), np.split(codes, cuts), np.split(counts, cuts)):
                if len(s):
                    steps = np.diff(c, prepend=c.dtype.type(0))
                    out.append((int(s[0]), chunk, packed(steps), packed(n)))
        return pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate(
                (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
            ["shard", "chunk", "codes", "counts"])
    return common.arrow_pass(chunks.select("chunk", "n_a", "n_b", "a", "b"),
                             "shard int, chunk long, codes binary, counts binary", each)


def _shards(codes: np.ndarray, pair: Pair, shards: int) -> np.ndarray:
    """The shard of each pair, by its A id."""
    return (mixed(codes // codes.dtype.type(pair.b.size)) % np.uint64(shards)).astype(np.int64)


def pair_counts(asked: DataFrame, path_a: str, path_b: str, shards: int, salts: int) -> DataFrame:
    """Per shard its perfect hash, the dense vector of counts, and which pairs have the highest
    count of their A id."""
    both = lambda: tokenizers(path_a, path_b)

    def local(batches):
        """Distinct pairs of a task per shard, sent on whenever many are held."""
        held: dict[int, list[np.ndarray]] = {}
        n = 0

        def sent():
            for shard, parts in held.items():
                codes = np.unique(np.concatenate(parts))
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "codes": pa.array([
                        packed(np.diff(codes, prepend=codes.dtype.type(0)))], pa.binary())})
        for shard, raw in common.rows_of(batches, ("shard", "codes")):
            held.setdefault(shard, []).append(_codes(raw, both()))
            n += len(held[shard][-1])
            if n > 8_000_000:
                yield from sent()
                held, n = {}, 0
        yield from sent()

    def build(batches):
        for shard, rows in groupby(common.rows_of(batches, ("shard", "codes")), key=lambda r: r[0]):
            known, more, n = np.empty(0, both().code), [], 0
            for _, raw in rows:
                more.append(_codes(raw, both()))
                n += len(more[-1])
                if n > max(1_000_000, len(known)):
                    known, more, n = np.unique(np.concatenate([known, *more])), [], 0
            sizes, bits, keys = PerfectHash.of(np.unique(np.concatenate([known, *more]))).packed()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "sizes": pa.array([sizes], pa.binary()),
                "bits": pa.array([bits], pa.binary()), "keys": pa.array([keys], pa.binary())})

    hash_ = "shard int, sizes binary, bits binary, keys binary"
    hashes = common.written(
        asked.select("shard", "codes").mapInArrow(local, "shard int, codes binary")
        .repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(build, hash_),
        "pair-hashes")

    def dense(batches):
        """The vector of one shard and salt."""
        columns = ("shard", "salt", "sizes", "bits", "keys", "codes", "counts")
        for (shard, _), rows in groupby(common.rows_of(batches, columns), key=lambda r: r[:2]):
            found = total = None
            for _, _, sizes, bits, keys, codes, counts in rows:
                if sizes is not None:
                    found = PerfectHash.unpacked(sizes, bits, keys, both().code)
                    total = np.zeros(len(found.keys), np.int64)
                else:
                    total[found.find(_codes(codes, both()))] += unpacked(counts).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()),
                                              "vector": pa.array([packed(total)], pa.binary())})

    salted = common.beside(hashes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
                    asked.select("shard", F.pmod("chunk", F.lit(salts)).cast("int").alias("salt"),
                                 "codes", "counts"), shards * salts, ["shard", "salt"])
    vectors = salted.mapInArrow(dense, "shard int, vector binary")

    def summed(batches):
        pair = tokenizers(path_a, path_b)
        columns = ("shard", "sizes", "bits", "keys", "vector")
        for shard, rows in groupby(common.rows_of(batches, columns), key=lambda r: r[0]):
            total = hash_of = None
            for _, sizes, bits, keys, vector in rows:
                if sizes is not None:
                    hash_of, total = (sizes, bits, keys), np.zeros(len(keys) // pair.code.itemsize,
                                                                   np.int64)
                else:
                    total += unpacked(vector).astype(np.int64)
            keys = np.frombuffer(hash_of[2], pair.code)
            _, a = np.unique(keys // pair.code.type(pair.b.size), return_inverse=True)
            most = np.zeros(int(a.max(initial=-1)) + 1, np.int64)
            np.maximum.at(most, a, total)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()),
                **{c: pa.array([v], pa.binary()) for c, v in zip(("sizes", "bits", "keys"), hash_of)},
                "counts": pa.array([packed(total)], pa.binary()),
                "best": pa.array([packed((total == most[a]).astype(np.uint8))], pa.binary())})
    return common.written(common.beside(hashes, vectors, shards, ["shard"])
                          .mapInArrow(summed, hash_ + ", counts binary, best binary"), "pair-counts")


def counts_of(pairs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a, b, n, best: every pair of ids with the number of documents that hold it linked."""
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        pair, parts = tokenizers(path_a, path_b), []
        for keys, counts, best in common.rows_of([batch], ("keys", "counts", "best")):
            codes = np.frombuffer(keys, pair.code).astype(np.int64)
            parts.append((codes // pair.b.size, codes % pair.b.size,
                          unpacked(counts).astype(np.int64), unpacked(best) > 0))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)],
                                          ["a", "b", "n", "best"])
    return common.arrow_pass(pairs.select("keys", "counts", "best"),
                             "a long, b long, n long, best boolean", each)


def align(docs: DataFrame, path_a: str, path_b: str, shards: int = 64, salts: int = 4,
          chunk_chars: int = 1_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (`a1,a2|b1;a3|b2,b3`, null
    without tokens) for every row."""
    n = pages.partitions(docs.sparkSession)
    chunks = common.written(encoded_chunks(docs, path_a, path_b, chunk_chars), "encoded-chunks")
    asked = common.written(asked_pairs(chunks, path_a, path_b, shards), "asked-pairs")
    known = pair_counts(asked, path_a, path_b, shards, salts)

    def answers(batches):
        pair = tokenizers(path_a, path_b)
        columns = ("shard", "salt", "sizes", "bits", "keys", "counts", "best", "chunk", "codes")
        for (shard, _), rows in groupby(common.rows_of(batches, columns), key=lambda r: r[:2]):
            for _, _, sizes, bits, keys, counts, best, chunk, codes in rows:
                if sizes is not None:
                    found = PerfectHash.unpacked(sizes, bits, keys, pair.code)
                    total, top = unpacked(counts), unpacked(best)
                else:
                    at = found.find(_codes(codes, pair))
                    yield pa.RecordBatch.from_pydict({
                        "chunk": pa.array([chunk], pa.int64()),
                        "shard": pa.array([shard], pa.int32()),
                        "counts": pa.array([packed(total[at])], pa.binary()),
                        "best": pa.array([packed(top[at])], pa.binary())})

    looked = common.beside(known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
                    asked.select("shard", F.pmod("chunk", F.lit(salts)).cast("int").alias("salt"),
                                 "chunk", "codes"), shards * salts, ["shard", "salt"])
    found = looked.mapInArrow(answers, "chunk long, shard int, counts binary, best binary")

    def again(batches):
        pair = tokenizers(path_a, path_b)
        shown = [f"{i}{sep}" for i in range(max(pair.a.size, pair.b.size)) for sep in ",|;"]
        columns = ("chunk", "ids", "n_a", "n_b", "a", "b", "counts", "best")
        for _, rows in groupby(common.rows_of(batches, columns), key=lambda r: r[0]):
            _, ids, *row, _, _ = next(rows)
            a, b, n_a, n_b = _chunk(row, pair)
            links = Links(pair, a, b, n_a, n_b)
            got = [(unpacked(r[6]).astype(np.int64), unpacked(r[7]) > 0) for r in rows]
            codes = links.distinct()[0]
            shard, inverse = _shards(codes, pair, shards), np.searchsorted(codes, links.codes)
            counts, best = np.empty(len(codes), np.int64), np.empty(len(codes), bool)
            if got:   # by shard, and in order within it, as they were asked for
                order = np.lexsort((codes, shard))
                counts[order] = np.concatenate([g[0] for g in got])
                best[order] = np.concatenate([g[1] for g in got])
            sums = [np.diff(np.concatenate([[0], np.cumsum(v[inverse].astype(np.int64))])[
                np.concatenate([[0], links.until])]) for v in (best, counts)]
            texts = [t or None for t in links.texts(a, b, shown)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(np.asarray(v, np.int64)) for v in (
                    n_a, n_b, links.groups, links.per_doc, *sums)), pa.array(texts, pa.string())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    both = (chunks.withColumn("shard", F.lit(-1))
            .unionByName(found, allowMissingColumns=True)
            .repartition(n, "chunk").sortWithinPartitions("chunk", "shard"))
    return both.select("chunk", "ids", "n_a", "n_b", "a", "b", "counts", "best").mapInArrow(
        again, _COLUMNS)
