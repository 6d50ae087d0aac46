"""Chat formatting: conversations rebuilt from an event log, rendered with a loss mask.

The log has one row per event: conv_id, turn, message, seq, kind, role, text. It is partitioned and
sorted by conversation, turn, message and seq, and folded as it streams by: ``delta`` adds to the
message's text, ``edit`` replaces it, ``regenerate`` empties it (the deltas that follow build the
new answer), ``delete`` takes the message out until a later event of it; ``open`` and kinds not
named here only make the message known. What a task holds is one message and one part of the output.

The template marks a user's turn as ``[INST]…[/INST]``, an assistant's as ``…</s>`` and any other
role as ``[ROLE]role[/ROLE]…</s>``. Control strings inside texts and roles get a backslash after
their first character, and one more if they have some there already; reading back takes it out
again, so every text comes back as it was and no text can pose as a mark.

The output is parts: runs of whole turns of one conversation, a conversation being one part unless
it is long or lies on the border of two tasks, with the places of its assistant texts as loss spans
(in characters of the part). A conversation of any size is spread over tasks by its turns; only its
SHA-256 needs its turns in one line, and these pass by as a stream.

Null text is empty, a null role is the empty role (not a user). Rows without a conversation number
form a conversation of their own, rows without a turn come first. An event delivered twice (same
message and seq) counts once, the first by kind and text; events without a seq are left out.
Messages of the same turn follow each other by their ``message`` text. An empty log gives no rows.
Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, pages

#: The marks of the template and of the models it is for, as they stand behind ``<`` or ``[``.
MARKS = r"/?(?:s>|INST\]|ROLE\])"
_RAW = re.compile(rf"([<\[])(\\*{MARKS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*{MARKS})")

_EVENT = ("conv_id", "turn", "message", "seq", "kind", "role", "text")
_PART = ("conv_id long, turn long, message string, n_turns long, text string, "
         "loss_begin array<long>, loss_end array<long>")
_PART_ARROW = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("message", pa.string()),
                         ("n_turns", pa.int64()), ("text", pa.string()),
                         ("loss_begin", pa.list_(pa.int64())), ("loss_end", pa.list_(pa.int64()))])
_DIGEST = "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_ARROW = pa.schema([*_PART_ARROW, ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                           ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escaped(text: str) -> str:
    return _RAW.sub(r"\1\\\2", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its own text begins and ends in it."""
    mark = {"user": "[INST]", "assistant": ""}.get(role, f"[ROLE]{escaped(role)}[/ROLE]")
    body = escaped(text)
    return (mark + body + ("[/INST]" if role == "user" else "</s>"), len(mark),
            len(mark) + len(body))


def read_back(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted part."""
    at = 0
    while at < len(text):
        role, close = "assistant", "</s>"
        if text.startswith("[INST]", at):
            role, close, at = "user", "[/INST]", at + 6
        elif text.startswith("[ROLE]", at):
            until = text.index("[/ROLE]", at)
            role, at = unescaped(text[at + 6:until]), until + 7
        end = text.index(close, at)
        yield role, unescaped(text[at:end])
        at = end + len(close)


def folded(events: Iterable[tuple]) -> tuple[str, str] | None:
    """Role and final text of one message from its (seq, kind, role, text) in order; None if it
    was deleted."""
    role, text, there, last = None, [], True, None
    for seq, kind, said, more in events:
        if seq is None or seq == last:
            continue
        last, there = seq, kind != "delete"
        role = said if role is None else role
        if kind in ("edit", "regenerate", "delete"):
            text = []
        if kind in ("delta", "edit") and more:
            text.append(more)
    return (role or "", "".join(text)) if there and last is not None else None


def format_log(events: DataFrame, part_chars: int = 1_000_000) -> DataFrame:
    """Formatted parts of every conversation of an event log."""
    def parts(batches) -> Iterator[dict]:
        held: dict | None = None
        for (conv, turn, message), log in groupby(common.rows_of(batches, _EVENT, 2048), key=lambda r: r[:3]):
            made = folded(r[3:] for r in log)
            if made is None:
                continue
            if held is not None and (held["conv_id"] != conv or held["size"] > part_chars):
                yield held
                held = None
            if held is None:
                held = {"conv_id": conv, "turn": turn, "message": message, "n_turns": 0, "size": 0,
                        "text": [], "loss_begin": [], "loss_end": []}
            text, begin, end = rendered(*made)
            if made[0] == "assistant":
                held["loss_begin"].append(held["size"] + begin)
                held["loss_end"].append(held["size"] + end)
            held["text"].append(text)
            held["size"] += len(text)
            held["n_turns"] += 1
        if held is not None:
            yield held

    def run(batches):
        out, size = [], 0
        for part in parts(batches):
            size += part.pop("size")
            out.append({**part, "text": "".join(part["text"])})
            if size > 4_000_000 or len(out) >= 2048:
                yield pa.RecordBatch.from_pylist(out, _PART_ARROW)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, _PART_ARROW)

    kinds = ("long", "long", "string", "long", "string", "string", "string")
    log = events.select(*[F.col(f"`{c}`").cast(k).alias(c) for c, k in zip(_EVENT, kinds)])
    spread = log.repartitionByRange(pages.partitions(events.sparkSession), "conv_id", "turn", "message")
    return spread.sortWithinPartitions(*_EVENT).mapInArrow(run, _PART)


class _Digest:
    """Digests of one conversation, read back from its parts."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, part: dict) -> None:
        for role, text in read_back(part["text"]):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for begin, end in zip(part["loss_begin"], part["loss_end"]):
            said = unescaped(part["text"][begin:end])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(part["text"])

    def row(self, conv: int | None) -> dict:
        return {"conv_id": conv, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(),
                "formatted_chars": self.chars}


def digests(parts: DataFrame, hold_chars: int = 4_000_000) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every
    conversation, read back from its formatted parts as ``format_log`` gives them.

    A conversation that lies within a task is read there. Parts of those at a task's borders, and of
    those longer than ``hold_chars``, meet in a second step, in which they pass by one at a time.
    """
    columns = [f.name for f in _PART_ARROW]

    def dicts(batches) -> Iterator[dict]:
        for row in common.rows_of(batches, columns, 2048):
            yield dict(zip(columns, row))

    def inside(batches) -> Iterator[dict]:
        before: list[dict] = []      # the conversation before, held until it is known to have ended
        for nth, (conv, run) in enumerate(groupby(dicts(batches), key=lambda p: p["conv_id"])):
            if before:
                digest = _Digest()
                for part in before:
                    digest.add(part)
                yield digest.row(before[0]["conv_id"])
            before, size, open_ = [], 0, nth == 0
            for part in run:
                if not open_:
                    before.append(part)
                    size += len(part["text"])
                    open_ = size > hold_chars
                    if not open_:
                        continue
                    yield from before
                    before = []
                else:
                    yield part
        yield from before

    def whole(batches) -> Iterator[dict]:
        for conv, run in groupby(dicts(batches), key=lambda p: p["conv_id"]):
            digest = _Digest()
            for part in run:
                digest.add(part)
            yield digest.row(conv)

    def run(each):
        def go(batches):
            out, size = [], 0
            for row in each(batches):
                out.append(row)
                size += len(row.get("text") or "")
                if size > 4_000_000 or len(out) >= 2048:
                    yield pa.RecordBatch.from_pylist(out, _DIGEST_ARROW)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, _DIGEST_ARROW)
        return go

    shape = f"{_PART}, {_DIGEST}"
    first = common.written(parts.select(*columns).mapInArrow(run(inside), shape), "chat-digests")
    border = (first.where(F.col("text").isNotNull()).select(*columns)
              .repartition(pages.partitions(parts.sparkSession), "conv_id")
              .sortWithinPartitions("conv_id", "turn", "message").mapInArrow(run(whole), shape))
    return first.where(F.col("text").isNull()).unionByName(border).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def as_events(conversations: DataFrame, chunk: int = 512) -> DataFrame:
    """An event log that ends in the given rows (conv_id, turn, role, text).

    Answers are streamed in deltas of ``chunk`` characters, and the third part of them was begun
    once before and regenerated; other messages come whole, and the third part of them as an edit
    of a first draft. Rows of one turn are told apart by role, a hash of the text, and a row number.
    """
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("role").cast("string")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                F.col("turn").cast("long").alias("turn"), role.alias("role"),
                                text.alias("text"))
    rows = rows.withColumn("message", F.concat_ws(
        ":", F.coalesce("role", F.lit("")), F.hex(F.xxhash64("text")),
        F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")))
    pieces = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{chunk}}}"), F.lit(0))
    again = F.pmod(F.xxhash64("message"), F.lit(3)) == 0
    none = F.lit(None).cast("string")

    def event(seq, kind, text, role=none):
        return F.struct(F.lit(seq).cast("long").alias("seq") if isinstance(seq, int)
                        else seq.cast("long").alias("seq"), F.lit(kind).alias("kind"),
                        role.alias("role"), text.alias("text"))
    begun = F.array(event(0, "open", none, F.col("role")))
    draft = F.when(again, F.array(event(1, "delta", F.substring("text", 1, 40)),
                                  event(2, "regenerate", none))).otherwise(F.array())
    answer = F.concat(begun, draft, F.transform(pieces, lambda x, i: event(i + 3, "delta", x)))
    plain = F.when(again, F.concat(begun, F.array(event(1, "delta", F.substring("text", 1, 40)),
                                                  event(2, "edit", F.col("text"))))
                   ).otherwise(F.concat(begun, F.array(event(1, "delta", F.col("text")))))
    log = F.when(F.col("role") == "assistant", answer).otherwise(plain)
    return rows.select("conv_id", "turn", "message", F.explode(log).alias("e")).select(
        "conv_id", "turn", "message", "e.*")
