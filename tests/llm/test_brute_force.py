"""Site posteriors in plain Python, edges of language and similarity, and how much the grid rules out."""

import hashlib
import math
import os
import random
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rillhouse.llm import hard_negatives, language, lines, pages, pii, shingle_join, sites, vector_dedup

LARGER = "/root/testdata/sf0.1/embeddings.parquet"


def posteriors(rows, labels):
    """(p_host, p_path, score) of rows (doc_id, host, path, p_doc), by loops."""
    known = defaultdict(list)
    for i, good in labels:
        if i is not None and good is not None:
            known[i].append(good)
    y = [sum(known[i]) / len(known[i]) if i in known else p for i, _, _, p in rows]
    hosts, paths = defaultdict(list), defaultdict(list)
    for (_, host, path, _), value in zip(rows, y):
        hosts[host].append(value)
        paths[host, path].append(value)
    mean = sum(y) / len(y)

    def strength(groups, toward, first):
        spread = n = 0.0
        for key, values in groups.items():
            own, k = sum(values) / len(values), len(values)
            noise = (sum(v * v for v in values) / k - own * own) / max(k - 1, 1)
            spread += k * ((own - toward(key)) ** 2 - noise)
            n += k
        return {min(max(f * (1 - f) / max(spread / n, 1e-6), 1.0), 1e6) for f in first}

    host_strength = strength(hosts, lambda _: mean, [mean])
    s = host_strength.pop()
    p_host = {h: (sum(v) + s * mean) / (len(v) + s) for h, v in hosts.items()}
    logit = lambda p: math.log(min(max(p, 1e-4), 1 - 1e-4) / (1 - min(max(p, 1e-4), 1 - 1e-4)))
    results = []
    # One mean of any host stands for all in the strength of paths.
    for t in strength(paths, lambda key: p_host[key[0]], list(p_host.values())):
        out = []
        for (i, host, path, p), value in zip(rows, y):
            own = paths[host, path]
            rest = (sum(own) - value + t * p_host[host]) / (len(own) - 1 + t)
            out.append((p_host[host], rest, 1 / (1 + math.exp(-(logit(p) + logit(rest) - logit(mean))))))
        results.append(out)
    return results


def test_site_posteriors_by_loops(spark):
    texts = ["Good plain words here.", "BUY BUY BUY now now", "", None, "a longer text\nwith lines\nand words"]
    rows = [(i, texts[i % 5], f"h{i % 3 if i < 40 else 4}", f"p{i % 4}" if i % 7 else None) for i in range(60)]
    labels = [(i, int(i % 3 == 0)) for i in range(0, 45, 2)] + [(4, 1), (4, 0), (None, 1), (5, None), (9999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    got = sites.score(docs, spark.createDataFrame(labels, "doc_id long, quality int"), F.col("host"), F.col("path"))
    made = sorted(got.collect(), key=lambda r: r.doc_id)
    want = posteriors([(r.doc_id, r.host, r.path, r.p_doc) for r in made], labels)
    close = [all(math.isclose(a, b, abs_tol=1e-9) for r, w in zip(made, each)
                 for a, b in zip((r.p_host, r.p_path, r.score), w)) for each in want]
    assert any(close) and all(r.keep == (r.score >= 0.5) for r in made)


def test_no_letter_is_no_language(spark):
    rows = [(i, "the words of one tongue and more of them", "en") for i in range(40)]
    rows += [(100 + i, "die Wörter einer anderen Sprache und mehr davon", "de") for i in range(40)]
    odd = {200: "½ ² Ⅷ ① 12", 201: "…—!? \n\t", 202: None, 203: "", 204: "_-_ 7", 205: "ª", 206: "中", 207: "the words"}
    docs = spark.createDataFrame(rows + [(i, t, None) for i, t in odd.items()], "doc_id long, text string, lang string")
    name = language.found_name(docs)
    got = {r.doc_id: r[name] for r in language.identify(docs).collect()}
    assert [got[i].lang_pred for i in (200, 201, 202, 203, 204)] == ["und"] * 5
    assert all(got[i].lang_pred in ("en", "de") for i in (205, 206, 207))
    assert all(got[i].score == 0 for i in (200, 202)) and all(0 <= f.score <= 1 for f in got.values())
    more = language.identify(docs.withColumn("__found", F.lit(1))).columns
    assert "__found" in more and len(more) == 5


@pytest.mark.parametrize("percent", [0, 50, 66, 101])
def test_similarities_that_would_lose_links_are_refused(spark, percent):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e")], "doc_id long, text string")
    with pytest.raises(ValueError):
        shingle_join.near_duplicates(docs, percent=percent)


def test_short_lines_and_very_long_texts(spark):
    tail = "\n".join(f"line {i} of a very long text" for i in range(30_000))
    rows = [(i, f"own {i}\nAll rights reserved.\n", f"s{i}") for i in range(24)] + [(99, tail + "\nAll rights reserved.", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by = {r.doc_id: r for r in lines.drop_boilerplate(docs).collect()}
    assert by[0].text == rows[0][1] and by[1].text == "own 1\n" and by[99].text == tail
    assert by[99]["__n_lines"] == 30_001 and by[99]["__n_removed"] == 1


def _distinct(spark):
    return (spark.read.parquet(LARGER).where(F.col("label").isNotNull() & pages.usable("embedding"))
            .select(F.col("label").cast("long"), F.col("vec_id").alias("rep"), F.lit(1).cast("long").alias("copies"),
                    F.col("embedding").cast("array<double>").alias("v")))


@pytest.mark.skipif(not os.path.exists(LARGER), reason="needs the larger table")
def test_share_of_pairs_that_is_compared(spark):
    distinct = _distinct(spark)
    pairs = distinct.groupBy("label").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    found = vector_dedup.verified(distinct, 0.98, 8192, 16, 4096, 1.0)
    looked = found.agg(F.sum("looked")).first()[0]
    print(f"pairs compared by the grid: {looked / pairs:.2f} of those of equal label")
    assert looked < 0.85 * pairs
    points = distinct.select(F.col("rep").alias("vec_id"), "label", F.transform(
        "v", lambda x: F.floor(256 * x)).alias("v"))
    index = hard_negatives.build(points, 10)
    size = index.stored.groupBy("leaf").agg(F.sum("n").alias("rows"))
    limit = lambda x: F.array(F.lit(x).cast("long"))
    anchors = points.where("vec_id % 100 = 0").withColumns({"high": limit(hard_negatives.NO_LIMIT),
                                                           "low": limit(20_000)})
    seen = index.visits(anchors, None).join(size, "leaf").agg(F.sum(F.col("asked") * F.col("rows"))).first()[0]
    print(f"rows scored by the cover tree: {seen / (anchors.count() * points.count()):.2f} of all")


def plain_characters(text, key, label):
    """The keyed permutation of a text's letters and digits, by loops."""
    def digest(*parts):
        return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()

    def kind(c):
        return ((48, 10) if c in string.digits else (65, 26) if c in string.ascii_uppercase
                else (97, 26) if c in string.ascii_lowercase else None)

    at = [i for i, c in enumerate(text) if kind(c)]
    numbers, ranges = [ord(text[i]) - kind(text[i])[0] for i in at], [kind(text[i])[1] for i in at]
    if len(at) == 1:
        order = sorted(range(ranges[0]), key=lambda x: digest(key, label, "single", x))
        numbers = [order.index(numbers[0])]
    else:
        for turn in range(pii.ROUNDS):
            others = ",".join(str(x) for i, x in enumerate(numbers) if i % 2 != turn % 2)
            numbers = [(x + int(digest(key, label, turn, i, others)[:12], 16)) % r if i % 2 == turn % 2 else x
                       for i, (x, r) in enumerate(zip(numbers, ranges))]
    out = list(text)
    for i, x in zip(at, numbers):
        out[i] = chr(kind(text[i])[0] + x)
    return "".join(out)


def test_characters_by_loops(spark):
    rng = random.Random(8)
    texts = [*string.ascii_letters, *string.digits, "", "..", "a.b", "z.b", "é1", "A-1", *(
        "".join(rng.choice(string.ascii_letters + string.digits + "._-é") for _ in range(rng.randint(1, 20)))
        for _ in range(150))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", pii.characters(F.col("t"), "k", "l").alias("p")).withColumn(
        "back", pii.characters(F.col("p"), "k", "l", True)).collect()
    assert all(r.p == plain_characters(r.t, "k", "l") and r.back == r.t for r in got)
    moved = {r.t: r.p for r in got}
    letters = [moved[c] for c in string.ascii_lowercase]
    assert sorted(letters) == list(string.ascii_lowercase)
    assert len({(ord(p) - ord(c)) % 26 for c, p in zip(string.ascii_lowercase, letters)}) > 5     # no fixed shift
