"""Language identification by a byte-level convolutional network.

Windows of ``WINDOW`` bytes: every byte has a small vector, filters of several widths slide over
them, each filter keeps its largest response, and a softmax layer names the language. The network
is trained in numpy on a bounded sample of windows of labelled documents. Applied, a filter is a
sum of table look-ups for byte pairs and single bytes; all windows of a text count, by their bytes.

A null text, or one without any letter, is ``und`` with score 0; so is every text where no row
was labelled. Equal scores go to the language first in order. Repeated rows and null ids are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

UNKNOWN = "und"
WINDOW, WIDTHS, FILTERS, VECTOR = 256, (2, 3, 4), 8, 8
_LETTER = regex.compile(r"\p{L}")   # by the letter classes of Unicode


def windows(text: str | bytes) -> np.ndarray:
    """All windows of a text; the last one is filled up with zero bytes."""
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "replace")
    whole = np.zeros(max(1, -(-len(raw) // WINDOW)) * WINDOW, np.uint8)
    whole[:len(raw)] = np.frombuffer(raw, np.uint8)
    return whole.reshape(-1, WINDOW)


class Network:
    """Parameters, training, and look-up tables for use."""

    def __init__(self, languages: Sequence[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = list(languages)
        n = len(self.languages)
        self.params = {"bytes": rng.normal(0, 0.5, (256, VECTOR)), "out_b": np.zeros(n),
                       "out": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, n))}
        for w in WIDTHS:
            self.params[f"f{w}"] = rng.normal(0, (w * VECTOR) ** -0.5, (w, VECTOR, FILTERS))
            self.params[f"b{w}"] = np.zeros(FILTERS)

    def _responses(self, batch: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per width: the largest response of each filter and where it is."""
        out = []
        for w in WIDTHS:
            tables = self.params["bytes"] @ self.params[f"f{w}"]
            span = WINDOW - w + 1
            got = sum(tables[o][batch[:, o:o + span]] for o in range(w)) + self.params[f"b{w}"]
            at = got.argmax(axis=1)
            out.append((np.take_along_axis(got, at[:, None], 1)[:, 0], at))
        return out

    def step(self, batch: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients."""
        p, n = self.params, len(batch)
        found = self._responses(batch)
        pooled = np.concatenate([m for m, _ in found], axis=1)
        active = np.maximum(pooled, 0)
        logits = active @ p["out"] + p["out_b"]
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        loss = -np.log(chance[np.arange(n), wanted] + 1e-12).mean()
        off = chance.copy()
        off[np.arange(n), wanted] -= 1
        off /= n
        grads = {"out": active.T @ off, "out_b": off.sum(axis=0), "bytes": np.zeros_like(p["bytes"])}
        back = (off @ p["out"].T) * (pooled > 0)
        for k, w in enumerate(WIDTHS):
            down, at = back[:, k * FILTERS:(k + 1) * FILTERS], found[k][1]
            kernel = p[f"f{w}"]
            grad = np.zeros_like(kernel)
            for o in range(w):
                seen = np.take_along_axis(batch, at + o, 1)   # the byte under this filter cell
                grad[o] = np.einsum("nfd,nf->df", p["bytes"][seen], down)
                np.add.at(grads["bytes"], seen, down[:, :, None] * kernel[o].T[None])
            grads[f"f{w}"], grads[f"b{w}"] = grad, down.sum(axis=0)
        return loss, grads

    def train(self, data: np.ndarray, wanted: np.ndarray, steps: int = 700, batch: int = 96,
              rate: float = 0.01, seed: int = 7) -> "Network":
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(data), batch)
            _, grads = self.step(data[pick], wanted[pick])
            pace = rate * (1 - t / (steps + 1))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.params[k] -= pace * (first[k] / (1 - 0.9 ** t)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def packed(self) -> tuple:
        """A small hashable form for tasks."""
        return (tuple(self.languages), tuple((k, v.shape, v.astype(np.float32).tobytes())
                                             for k, v in sorted(self.params.items())))


class Tables:
    """A trained network as look-ups: pairs of bytes, then a single one where a width is odd."""

    def __init__(self, packed: tuple):
        self.languages, params = packed
        p = {k: np.frombuffer(raw, np.float32).reshape(shape) for k, shape, raw in params}
        self.out, self.out_b, self.steps = p["out"], p["out_b"], []
        for w in WIDTHS:
            single = p["bytes"] @ p[f"f{w}"]
            looks = []
            for o in range(0, w - 1, 2):
                looks.append((o, True, (single[o][:, None] + single[o + 1][None]).reshape(-1, FILTERS)
                              .astype(np.float32)))
            if w % 2:
                looks.append((w - 1, False, single[w - 1].astype(np.float32)))
            self.steps.append((w, looks, p[f"b{w}"]))

    def logits(self, batch: np.ndarray) -> np.ndarray:
        """Of windows, a few hundred at a time so that the responses stay in the CPU's cache."""
        out = np.empty((len(batch), len(self.languages)), np.float32)
        for begin in range(0, len(batch), 128):
            part = batch[begin:begin + 128]
            singles = part.astype(np.intp)
            pairs = (singles[:, :-1] << 8) + singles[:, 1:]
            pooled = []
            for w, looks, bias in self.steps:
                span, got = WINDOW - w + 1, None
                for o, paired, table in looks:
                    piece = table.take((pairs if paired else singles)[:, o:o + span], axis=0)
                    got = piece if got is None else np.add(got, piece, out=got)
                pooled.append(got.max(axis=1) + bias)
            out[begin:begin + 128] = np.maximum(np.concatenate(pooled, axis=1), 0) @ self.out + self.out_b
        return out

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        todo = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not todo or not self.languages:
            return names, scores
        raw = [texts[i].encode("utf-8", "replace") for i in todo]
        parts = [windows(r) for r in raw]
        logits = self.logits(np.concatenate(parts))
        at = 0
        for i, r, part in zip(todo, raw, parts):
            mine = logits[at:at + len(part)].astype(np.float64)
            at += len(part)
            share = np.full(len(part), float(WINDOW))
            share[-1] = len(r) - WINDOW * (len(part) - 1)
            mean = share @ mine / share.sum()
            chance = np.exp(mean - mean.max())
            chance /= chance.sum()
            best = int(chance.argmax())
            names[i], scores[i] = self.languages[best], float(chance[best])
        return names, scores


@lru_cache(maxsize=2)
def tables(packed: tuple) -> Tables:
    return Tables(packed)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that no training sees: crc32 of the id as text, divided by five, leaves 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quotas(there: dict[str, int], most: int) -> dict[str, int]:
    """Windows of each language, about ``most`` in all and at least one."""
    if sum(there.values()) <= most:
        return there
    even = max(1, most // (4 * len(there)))
    low = {lang: min(n, even) for lang, n in there.items()}
    left = max(0, most - sum(low.values()))
    more = sum(there.values()) - sum(low.values())
    return {lang: low[lang] + left * (n - low[lang]) // max(1, more) for lang, n in there.items()}


def fit(labelled: DataFrame, max_windows: int = 12_000, per_text: int = 4) -> tuple:
    """Train on rows of doc_id, text, lang with a language and letters.

    The sample is bounded: up to ``per_text`` windows of a text, at places drawn from a hash of
    its id, and of these, for each language, as many as it is due that come first by another
    hash. A quarter of ``max_windows`` is dealt out evenly, so that a rare language is learnt too,
    the rest by what each has more. How many there are is added up first, so that tasks hand over
    about that many windows in all.
    """
    known = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                            F.col("lang").cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    windows_of = F.least(F.ceil(F.octet_length("text") / WINDOW), F.lit(per_text))
    there = {r.lang: int(r.n or 0) for r in known.groupBy("lang").agg(F.sum(windows_of).alias("n")).collect()}
    due = quotas(there, max_windows)
    share = {lang: min(1.0, (1.2 * due[lang] + 10) / max(1, n)) for lang, n in there.items()}

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text, lang in zip(*(batch.column(c).to_pylist()
                                        for c in ("doc_id", "text", "lang"))):
            if not _LETTER.search(text):
                continue
            all_ = windows(text)
            rng = np.random.default_rng((doc_id or 0) & 0x7FFFFFFFFFFFFFFF)
            for i in rng.permutation(len(all_))[:per_text]:
                draw = int(rng.integers(1 << 62))
                if draw <= share[lang] * (1 << 62):
                    rows.append((lang, all_[i].tobytes(), draw))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in
             enumerate((pa.string(), pa.binary(), pa.int64()))], ["lang", "bytes", "draw"])
    drawn = common.arrow_pass(known, "lang string, bytes binary, draw long", each).collect()
    taken, sample = Counter(), []
    for r in sorted(drawn, key=lambda r: (r.draw, bytes(r.bytes), r.lang)):
        if taken[r.lang] < due[r.lang]:
            taken[r.lang] += 1
            sample.append(r)
    languages = sorted({r.lang for r in sample})
    network = Network(languages)
    if sample:
        data = np.stack([np.frombuffer(r.bytes, np.uint8) for r in sample]).astype(np.intp)
        place = {lang: i for i, lang in enumerate(languages)}
        network.train(data, np.array([place[r.lang] for r in sample]))
    return network.packed()


def predicted(packed: tuple, text: Column) -> Column:
    """struct(lang_pred, score) of a text column, in batches."""
    @F.pandas_udf("lang_pred string, score double")
    def run(column: pd.Series) -> pd.DataFrame:
        texts, names, scores = [t if isinstance(t, str) else None for t in column], [], []
        for at in range(0, len(texts), common.BATCH_ROWS):
            some = tables(packed).predict(texts[at:at + common.BATCH_ROWS])
            names.extend(some[0])
            scores.extend(some[1])
        return pd.DataFrame({"lang_pred": pd.Series(names, dtype=object),
                             "score": pd.Series(scores, dtype=float)})
    return run(text)


def identify(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, lang) and one struct column ``found``, whose name
    is returned by ``found_name``; learnt on the rows that are not held out."""
    packed = fit(docs.where(~held_out()))
    return docs.withColumn(found_name(docs), predicted(packed, F.col("text").cast("string")))


def found_name(docs: DataFrame) -> str:
    return "__found" if "__found" not in docs.columns else "__found_language"
