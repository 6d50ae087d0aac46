"""Byte-pair encoding by backtracking, and decoding by an offset table.

A vocabulary with its merges is read from a public tokenizer file. A word is encoded by taking
the longest token that an Aho-Corasick automaton found at the current place; it stands if the
pair (token before, token) is compatible, which means that merging their joined bytes would
give just these two. Otherwise a shorter token is tried, and when none is left the last token is
taken back. Encodings of prefixes are unique, so a place that failed once is never tried
again: the work is linear in the word. A sequence whose neighbours are all compatible is the
sequence the merges give.

Texts: null is the empty text, and gives no tokens. A word may be of any length; no text is cut.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Cached words per Python worker; a full cache is emptied, which costs time only.
CACHE_WORDS = 350_000
_END = "Ā"   # stands for the end of a word; bytes are U+0000 to U+00FF


def byte_alphabet() -> dict[str, int]:
    """Printable characters stand for themselves, the other bytes for U+0100 and up in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special strings of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile(
            "(" + "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")")
        vocab: dict[str, int] = model["vocab"]

        def plain(token: str) -> str:
            ended = bool(self.suffix) and token.endswith(self.suffix)
            body = token[:-len(self.suffix)] if ended else token
            return "".join(chr(alphabet[c]) for c in body) + (_END if ended else "")

        self.by_text = {plain(t): i for t, i in vocab.items() if t not in self.specials}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.length = [0] * size
        for text, i in self.by_text.items():
            self.length[i] = len(text)
        # birth: when a token is made by the merges (-1: from the start); parts: of what.
        self.birth, self.parts = [-1] * size, [(-1, -1)] * size
        self.rank: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.rank[left, right] = rank
            self.birth[made], self.parts[made] = rank, (left, right)
        self.automaton = ahocorasick.Automaton()
        for text, i in self.by_text.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self._pairs: dict[tuple[int, int], bool] = {}
        # The offset table: token i is shown as shown[offsets[i]:offsets[i + 1]].
        names = [""] * size
        for name, i in [*vocab.items(), *self.specials.items()]:
            names[i] = name
        self.joined = spec["decoder"] is None   # then tokens are shown as they are, with spaces
        shown = [(n.encode() + b" ") if self.joined or n in self.specials
                 else bytes(alphabet[c] for c in n) for n in names]
        if not self.joined:
            shown = [s.removesuffix(b" ") if n in self.specials else s
                     for n, s in zip(names, shown)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.offsets = np.cumsum([0, *map(len, shown)])

    def compatible(self, left: int, right: int) -> bool:
        """Would merging the bytes of both give just these two tokens?

        Walks back in time over the last part of ``left`` and the first part of ``right``:
        the two are split by a merge across their border if that merge comes before the merges
        that used them up. Of equal merges the one further left comes first.
        """
        known = self._pairs.get((left, right))
        if known is not None:
            return known
        x, y, x_used, y_used, fits = left, right, 1 << 60, 1 << 60, True
        while True:
            across = self.rank.get((x, y))
            if across is not None and across < x_used and across <= y_used:
                fits = False
                break
            if self.birth[x] < 0 and self.birth[y] < 0:
                break
            if self.birth[x] > self.birth[y]:
                x_used, x = self.birth[x], self.parts[x][1]
            else:
                y_used, y = self.birth[y], self.parts[y][0]
        if len(self._pairs) > CACHE_WORDS:
            self._pairs.clear()
        self._pairs[left, right] = fits
        return fits

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word, the unit within which merges happen."""
        text = word.encode("utf-8", "surrogatepass").decode("latin-1") + (_END if self.suffix else "")
        whole = self.by_text.get(text)
        if whole is not None:
            return [whole]   # every token of these vocabularies is what its own bytes merge to
        length, n = self.length, len(text)
        found: list[list[int]] = [[] for _ in range(n)]
        for end, token in self.automaton.iter(text):
            found[end + 1 - length[token]].append(token)   # short ones first at each place
        out: list[int] = []
        tries = [len(found[0])]
        failed = bytearray(n + 1)
        at = 0
        while at < n:
            here, left = found[at], tries[-1]
            while left:
                left -= 1
                token = here[left]
                to = at + length[token]
                if not failed[to] and (not out or self.compatible(out[-1], token)):
                    break
            else:
                failed[at] = 1
                if not out:
                    raise ValueError(f"no tokens for {word!r}")
                tries.pop()
                at -= length[out.pop()]
                continue
            tries[-1] = left
            out.append(token)
            at = to
            tries.append(len(found[at]) if at < n else 0)
        return out

    def show(self, ids: np.ndarray) -> str:
        """The text of ids, by the offset table."""
        if not len(ids):
            return ""
        begin, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        until = np.cumsum(lengths)
        at = np.arange(until[-1]) + np.repeat(begin - (until - lengths), lengths)
        raw = self.shown[at].tobytes()
        return (raw[:-1] if self.joined else raw).decode("utf-8", "replace")


class _Units(dict):
    """Unit of text → packed ids, encoded when first met; at most ``most`` are kept."""

    def __init__(self, encode, most: int = CACHE_WORDS):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        packed = np.asarray(self.encode(unit), np.int32).tobytes()
        if len(unit) <= 64:
            self[unit] = packed
        return packed


class WordEncoder:
    """Lower-cased words with word ends; white space is dropped."""

    PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    FAR = re.compile("[̀-\U0010ffff]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.vocabulary = Vocabulary(path)
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.units = _Units(self._unit)

    def _unit(self, unit: str) -> list[int]:
        return [i for word in self.PATTERN.findall(unit) for i in self.vocabulary.encode_word(word)]

    def _plain(self, text: str) -> bytes:
        if self.FAR.search(text):
            clean = self.normalizer.normalize_str(text)
        else:   # composed already, and lower-cased letter by letter
            clean = text.lower().replace("\n", " ")
        return b"".join(map(self.units.__getitem__, clean.split(" ")))

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        v = self.vocabulary
        if "<|" not in text:
            return np.frombuffer(self._plain(text), np.int32)
        parts = [np.int32(v.specials[p]).tobytes() if p in v.specials else self._plain(p)
                 for p in v.special_pattern.split(text)]
        return np.frombuffer(b"".join(parts), np.int32)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One per Python worker."""
    return WordEncoder(path)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
           ) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) for every row, in one pass without a shuffle.

    Null text: no tokens. Repeated rows and null ids are kept as they are; other columns
    are left out. An empty table gives an empty table.
    """
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = word_encoder(path)
        ids = [encoder.encode(t) for t in batch.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = pa.array(np.concatenate(ids).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "n_tokens", "ids"])
    return common.arrow_pass(common.texts(docs, id_column, text_column),
                             "doc_id long, n_tokens long, ids array<int>", each)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` to rows of doc_id, n_tokens, ids; null ids are no tokens."""
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = word_encoder(path).vocabulary
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        lengths = np.array([0 if n is None else n for n in
                            pa.compute.list_value_length(lists).to_pylist()], np.int64)
        ends = np.cumsum(lengths)
        shown = [vocabulary.show(flat[e - n:e]) for e, n in zip(ends, lengths)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(shown, pa.string())],
                                          [*batch.schema.names, "decoded"])
    return common.arrow_pass(encoded.select("doc_id", "n_tokens", "ids"),
                             "doc_id long, n_tokens long, ids array<int>, decoded string", each)


def digests(decoded: DataFrame) -> DataFrame:
    """SHA-256 of the ids as decimal text and of the decoded text."""
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select("doc_id", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
