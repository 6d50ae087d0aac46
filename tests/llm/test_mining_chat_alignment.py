"""Hard negatives, chat formatting and tokenizer alignment against plain Python, with nulls,
repeats, ties, hot groups, empty tables and clashing columns."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rillhouse.llm import alignment, chat, hard_negatives
from rillhouse.llm.perfect_hash import PerfectHash

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CLASH = ("score", "anchor", "leaf", "page", "rank", "kind", "chunk", "n_a", "message")


def clashing(df):
    """With columns named as the operators name their own."""
    return df.withColumns({c: F.lit("clash") for c in CLASH})


# --- hard negatives ------------------------------------------------------------------------

def mined(rows, positives, negatives, low, high):
    """By comparing every anchor with every row."""
    known = {}
    for i, v, label, anchor in rows:
        if i is not None and label is not None and v is not None and all(
                x is not None and np.isfinite(x) for x in v):
            whole = (label, [int(np.floor(256 * x)) for x in v])
            old = known.get(i)
            known[i] = (min(whole, old[0]) if old else whole, anchor or bool(old and old[1]))
    out = []
    for a, ((label, v), anchor) in known.items():
        if not anchor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m == label)
                        for i, ((m, w), _) in known.items() if i != a)
        for s, p, _ in [r for r in scored if r[2]][:positives]:
            fit = [(-t, n) for t, n, same in scored
                   if not same and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(a, p, rank + 1, n, -s, t) for rank, (t, n) in enumerate(fit)]
    return sorted(out)


def vectors(n, seed, labels=3, width=6, copies=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 1) for _ in range(width)]
        if i % 4 == 0:                       # half of them near a label's own direction
            v[i % labels] += 3
        rows.append((i, v, i % labels, i % 9 == 0))
    rows += [(n + i, rows[0][1], i % 2, i == 3) for i in range(copies)]   # a hot group of ties
    return rows


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, is_anchor boolean")
    return clashing(made.repartition(3))


@pytest.mark.parametrize("seed, n, copies, extra", [
    (2, 90, 60, []),
    (3, 60, 0, [(500, None, 1, True), (501, [1.0, None, 2.0], 1, True), (None, [1.0] * 6, 1, True),
                (502, [1.0] * 6, None, True), (503, [float("nan")] * 6, 1, True), (504, [], 1, True),
                (505, [0.0] * 6, 1, True), (7, [9.0] * 6, 2, True), (506, [2.0], 0, True)]),
    (4, 2, 0, [])])
def test_mining_is_exact(spark, seed, n, copies, extra):
    rows = vectors(n, seed, copies=copies) + extra
    for arguments in ((5, 10, 30, 90), (2, 3, -50, 200))[:1 if seed > 2 else 2]:
        got = hard_negatives.mine(frame(spark, rows), F.col("is_anchor"), F.col("label"), "embedding",
                                  *arguments, page=16)
        assert sorted(map(tuple, got.collect())) == mined(rows, *arguments)


def test_mining_without_rows_or_anchors(spark):
    table = frame(spark, vectors(20, 1))
    assert hard_negatives.mine(table.where("1 = 0"), F.col("is_anchor"), F.col("label")).count() == 0
    assert hard_negatives.mine(table, F.lit(False), F.col("label")).count() == 0


def test_cover_tree_levels():
    x = hard_negatives.units(np.random.default_rng(2).integers(-300, 300, (400, 8)), 800_000, False)
    tree = hard_negatives.CoverTree(np.unique(x[:60], axis=0))
    leaf, far = tree.below(x)
    tree.measured({int(l): far[leaf == l].max(axis=0) for l in np.unique(leaf)})
    for nth, (level, path) in enumerate(zip(tree.level, tree.path)):
        assert set(tree.level[nth - 1 if nth else 0]) <= set(level)                  # nested
        to = hard_negatives.angles(x, tree.centres[level])[np.arange(len(x)), path[leaf]]
        assert (to <= tree.radius[nth][path[leaf]] + 1e-9).all()                     # covering


def test_mining_leaves_nodes_out_where_vectors_have_groups(spark):
    """With vectors in groups most nodes lie outside all windows."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (12, 24))
    rows = [(i, (3 * centres[i % 12] + 0.2 * rng.normal(0, 1, 24)).tolist(), i % 12 // 2, i % 40 == 0)
            for i in range(1200)]
    known = spark.createDataFrame(rows, "vec_id long, v array<double>, label long, anchor boolean").withColumn(
        "v", F.transform("v", lambda x: F.floor(256 * x)))
    index = hard_negatives.build(known.drop("anchor"), 10, page=64)
    limit = lambda x: F.array(F.lit(x).cast("long"))
    anchors = known.where("anchor").withColumns({"low": limit(-hard_negatives.NO_LIMIT),
                                                 "high": limit(hard_negatives.NO_LIMIT)})
    kth = index.search(anchors, 5, True).where("rank = 5").select(
        F.col("anchor").alias("vec_id"), F.array("score").alias("low"))
    size = index.stored.groupBy("leaf").agg(F.sum("n").alias("rows"))
    looked = (index.visits(anchors.drop("low").join(kth, "vec_id"), None).join(size, "leaf")
              .agg(F.sum(F.col("asked") * F.col("rows"))).first()[0])
    assert looked < 0.4 * 30 * 1200, looked / (30 * 1200)


def test_tree_is_built_in_little_memory():
    """The driver never holds the angles between all centres."""
    v = np.random.default_rng(5).integers(-300, 300, (1500, 16))
    x = hard_negatives.units(v, int((v * v).sum(1).max()), False)
    tracemalloc.start()
    try:
        tree = hard_negatives.CoverTree(x)
        assert tracemalloc.get_traced_memory()[1] < 10e6
    finally:
        tracemalloc.stop()
    for below, above, up in zip(tree.level[1:], tree.level, tree.above[1:]):
        assert (up == hard_negatives.angles(x[below], x[above]).argmin(1)).all()


def test_what_grows_with_anchors_is_not_broadcast(spark):
    """The driver would hold it; the positives' key of two columns takes 64 MB there at the least."""
    mining = hard_negatives.mine(frame(spark, vectors(60, 6)), F.col("is_anchor"), F.col("label"), page=8)
    plan = mining._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x and "nth#" in x]
    assert joins and not any("Broadcast" in x for x in joins), joins


def test_anchors_are_sent_once_a_group(spark):
    rows = [(i, np.floor(256 * np.array(v)).astype(int).tolist(), i % 3) for i, v, *_ in vectors(400, 6)]
    points = spark.createDataFrame(rows, "vec_id long, v array<long>, label long")
    index = hard_negatives.build(points, 10, page=8)
    limit = lambda x: F.array(F.lit(x).cast("long"))
    anchors = points.where("vec_id % 100 = 0").withColumns({"low": limit(-hard_negatives.NO_LIMIT),
                                                            "high": limit(hard_negatives.NO_LIMIT)})
    assert len(index.nodes) <= 16 < index.stored.count()
    assert index.sent(anchors, None).agg(F.sum("asked")).first()[0] == 4 * len(index.nodes)


def test_vectors_take_few_bytes():
    for most, size in ((2 ** 15 - 1, 2), (2 ** 15, 4), (2 ** 31, 8)):
        v = np.array([[0, -most, 1], [most, 5, 6]], np.int64)
        packed = hard_negatives._packed(v)
        assert len(packed) == 6 * size and (hard_negatives._unpacked(packed, 2, 3) == v).all()


def test_nodes_larger_than_a_group_share_several():
    x = hard_negatives.units(np.random.default_rng(2).integers(-300, 300, (60, 8)), 800_000, False)
    tree = hard_negatives.CoverTree(np.unique(x, axis=0))
    size = {leaf: 10 for leaf in range(0, len(tree.lowest), 2)} | {4: 2000}
    groups = hard_negatives._grouping(tree, size, 12)
    assert groups.keys() == size.keys() and groups[4][1] > 6
    assert all(0 <= start and span >= 1 and start + span <= 12 for start, span in groups.values())


@pytest.mark.parametrize("group", [200, 1500])
def test_mining_by_many_groups_is_exact(spark, group):
    """Groups smaller than a node."""
    rows = vectors(150, 8, copies=40) + [(700, [9000.0] * 6, 2, True)]
    got = hard_negatives.mine(frame(spark, rows), F.col("is_anchor"), F.col("label"), "embedding",
                              4, 6, 20, 95, page=4, group=group)
    assert sorted(map(tuple, got.collect())) == mined(rows, 4, 6, 20, 95)


def test_best_rows_are_kept_however_hits_are_cut(monkeypatch):
    monkeypatch.setattr(hard_negatives, "_HITS", 50)
    rng = np.random.default_rng(9)
    low = np.array([[-5, 0], [-100, 3], [3, hard_negatives.NO_LIMIT]])
    high = np.array([[5, 20], [100, 3], [30, -hard_negatives.NO_LIMIT]])
    who, scores, ids = rng.integers(0, 3, 900), rng.integers(-20, 20, 900), rng.permutation(900)
    best = hard_negatives._Best(7, low, high)
    for at in range(0, 900, 40):
        best.add(*(c[at:at + 40] for c in (who, ids, scores)))
    got = np.concatenate(best.found(np.array([10, 11, 12])))
    want = []
    for a in range(3):
        for w in range(2):
            fit = sorted((-s, n) for i, n, s in zip(who, ids, scores) if i == a and low[a, w] <= s <= high[a, w])
            want += [(10 + a, w, n, -s) for s, n in fit[:7]]
    assert sorted(map(tuple, got.tolist())) == sorted(want)
    assert best.low[1, 0] > -100 and (best.low >= low).all()


# --- chat ----------------------------------------------------------------------------------

TEXTS = ["", "ok", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST]", "[ROLE]x[/ROLE]", "a\nb", "é😀 [/INST",
         "[[INST]]", "<<s>>", "\\", "<s", None, "ROLE]", "[" * 5 + "INST]"]


def test_escapes_are_reversible():
    rng = random.Random(1)
    pieces = ["<", "[", "\\", "/", "s>", "INST]", "ROLE]", "x", "\n", "😀"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        hidden = chat.escaped(text)
        assert chat.unescaped(hidden) == text
        assert not any(mark in hidden for mark in ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"))
        role = rng.choice(["user", "assistant", "system", text])
        made, begin, end = chat.rendered(role, text)
        assert list(chat.read_back(made * 2)) == [(role, text)] * 2
        assert chat.unescaped(made[begin:end]) == text


def told(turns):
    said = [t for r, t in turns if r == "assistant"]
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest(),
            sum(len(chat.rendered(r, t)[0]) for r, t in turns))


def digests_of(spark, rows, **how):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = chat.format_log(chat.as_events(clashing(table).withColumn("seq", F.lit("clash")), chunk=7),
                            part_chars=how.pop("part_chars", 1_000_000))
    return {r.conv_id: tuple(r)[1:] for r in chat.digests(parts, **how).collect()}


@pytest.mark.parametrize("part_chars, hold_chars", [(1_000_000, 4_000_000), (20, 50)])
def test_conversations_come_back(spark, part_chars, hold_chars):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool\n<s>"]), rng.choice(TEXTS) if t % 2 else
             (rng.choice(TEXTS) or "") * 9) for c in range(30) for t in range(rng.randint(1, 6))]
    rows += [(77, t, "user" if t % 2 == 0 else "assistant", f"turn {t} </s>") for t in range(400)]   # a hot one
    rows += [(None, 0, "user", "no number"), (-7, 0, None, "no role"), (-7, None, "assistant", None)]
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        want[c].append((r or "", x or ""))
    got = digests_of(spark, rows, part_chars=part_chars, hold_chars=hold_chars)
    assert got == {c: told(turns) for c, turns in want.items()}


def test_repeated_rows_and_ties(spark):
    rows = [(1, 0, "user", "same"), (1, 0, "user", "same"), (1, 0, "assistant", "a"), (1, 1, "user", "x")]
    assert digests_of(spark, rows)[1] == told([("assistant", "a"), ("user", "same"), ("user", "same"), ("user", "x")])


def test_no_conversation(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_log(chat.as_events(empty))).count() == 0


def test_log_is_folded(spark):
    log = [  # conv, turn, message, seq, kind, role, text
        (1, 0, "u", 0, "open", "user", None), (1, 0, "u", 1, "delta", None, "hello"),
        (1, 0, "u", 9, "edit", None, "hello there"),
        (1, 1, "a", 0, "open", "assistant", None), (1, 1, "a", 1, "delta", None, "first "),
        (1, 1, "a", 2, "delta", None, "try"), (1, 1, "a", 3, "regenerate", None, None),
        (1, 1, "a", 4, "delta", None, "second "), (1, 1, "a", 5, "delta", None, "try"),
        (1, 1, "a", 5, "delta", None, "try"),                                   # delivered twice
        (1, 1, "a", None, "delta", None, "lost"), (1, 1, "a", 6, "cheer", None, "ignored"),
        (1, 2, "gone", 0, "open", "user", None), (1, 2, "gone", 1, "delta", None, "x"),
        (1, 2, "gone", 2, "delete", None, None),
        (1, 3, "late", 1, "delete", None, None), (1, 3, "late", 2, "delta", "user", "back")]
    random.Random(1).shuffle(log)
    table = spark.createDataFrame(log, "conv_id long, turn long, message string, seq long, kind string, "
                                  "role string, text string").withColumn("n_turns", F.lit("clash"))
    parts = sorted(chat.format_log(table).collect(), key=lambda p: p.turn)
    assert "".join(p.text for p in parts) == "[INST]hello there[/INST]second try</s>[INST]back[/INST]"
    assert [p.text[b:e] for p in parts for b, e in zip(p.loss_begin, p.loss_end)] == ["second try"]
    (whole,) = chat.format_log(table.coalesce(1).where("turn < 2").repartition(1)).groupBy("conv_id").agg(
        F.sum("n_turns").alias("n")).collect()
    assert whole.n == 2


# --- alignment -----------------------------------------------------------------------------

LONG = " ".join(f"word{i % 97} und{i % 13} überall" for i in range(6000))
DOCS = [(1, "Hello world, this is a test of tokens."), (2, None), (3, ""), (4, "Hello world, this is"),
        (4, "Hello world, this is"), (5, "naïve café — 中文 日本 😀 \U0001f9d1"), (6, LONG), (None, "no id here"),
        (7, "ﬁne ligature"), (8, "  two spaces  and\ttab\nnew line "), (9, "<|endoftext|> and </s> <unk> <0x41>"),
        (10, " "), (11, "aaaa" * 50), (12, "▁ under"), (13, "\x00\x01 odd"), (14, "é composed")]


def by_bytes(spark_rows):
    """Every link by comparing byte ranges token by token."""
    library, sp = Tokenizer.from_file(BYTES), alignment.processor(PIECES)
    library.encode_special_tokens = True
    shown = alignment.byte_alphabet()
    docs, count = [], Counter()
    for doc_id, text in spark_rows:
        a = b = []
        if text:
            a = library.encode(" " + text, add_special_tokens=False).ids
            b = sp.encode(text)
            raw_a = [bytes(shown[c] for c in library.id_to_token(i)) for i in a]
            raw_b = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i)
                     else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                a = b = []
        links, groups = [], []
        if a:
            ends_a, ends_b = np.cumsum([len(r) for r in raw_a]), np.cumsum([len(r) for r in raw_b])
            begin_b = ends_b - [len(r) for r in raw_b]
            for i, (x, e, r) in enumerate(zip(a, ends_a, raw_a)):
                links += [(x, b[j]) for j in np.flatnonzero((begin_b < e) & (ends_b > e - len(r)))]
            done_a = done_b = 0
            for e in sorted(set(ends_a) & set(ends_b)):
                to_a, to_b = int((ends_a <= e).sum()), int((ends_b <= e).sum())
                groups.append(",".join(map(str, a[done_a:to_a])) + "|" + ",".join(map(str, b[done_b:to_b])))
                done_a, done_b = to_a, to_b
            count.update(set(links))
        docs.append((doc_id, len(a), len(b), links, groups))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(i, na, nb, len(g), len(links), sum(count[p] == most[p[0]] for p in links),
             sum(count[p] for p in links), ";".join(g) or None) for i, na, nb, links, g in docs], count


def order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("chunk_chars, shards, salts", [(1_000_000, 4, 2), (30, 1, 3)])
def test_alignment_by_bytes(spark, chunk_chars, shards, salts):
    table = clashing(spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3))
    got = alignment.align(table, BYTES, PIECES, shards, salts, chunk_chars)
    want, _ = by_bytes(DOCS)
    assert sum(w[4] > 0 for w in want) >= 10      # most of these texts can be aligned
    assert order(got.collect()) == order(want)


def test_counts_of_pairs(spark):
    table = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(2)
    chunks = alignment.common.written(alignment.encoded_chunks(table, BYTES, PIECES, 200), "chunks")
    asked = alignment.asked_pairs(chunks, BYTES, PIECES, 3)
    got = alignment.counts_of(alignment.pair_counts(asked, BYTES, PIECES, 3, 2), BYTES, PIECES)
    assert {(r.a, r.b): r.n for r in got.collect()} == dict(by_bytes(DOCS)[1])


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, BYTES, PIECES).count() == 0
    (row,) = alignment.align(spark.createDataFrame([(1, None)], "doc_id long, text string"), BYTES, PIECES).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, None)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 200_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 31, n)).astype(np.uint32)
    made = PerfectHash.unpacked(*PerfectHash.of(keys).packed(), np.uint32)
    assert (np.sort(made.number(keys)) == np.arange(len(keys))).all()
    assert (made.keys[made.find(keys)] == keys).all()
    others = np.setdiff1d(keys + np.uint32(1), keys)
    assert (made.find(others) == -1).all()
