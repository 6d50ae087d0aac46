"""The numbered queries against SQL, and the pipeline against its own steps done by hand."""

import os
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from rillhouse.llm.oracles import ORACLES
from rillhouse.session import configure
from rillhouse.llm.queries import QUERIES
from test_operators import brute_components, shingle_set

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    before = configure(spark).conf.getAll
    assert differences(entry.queries()[name](spark, DATA), connect(DATA), ORACLES[name]) is None
    assert spark.conf.getAll == before


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(90001, None, "en", "s"), (90002, "12 34", None, "s"), (None, "no id at all here", "en", None)],
                                "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(odd, allowMissingColumns=True).withColumn("__gone", F.lit(1))
    stages = dict(corpus_pipeline.STAGES)

    known = stages["language_id"](spark, docs, DATA).cache()
    assert known.columns == docs.columns
    assert docs.count() - known.count() == 2   # the null text and the one without letters

    cleaned = stages["line_dedup"](spark, known, DATA).cache()
    assert cleaned.columns == docs.columns

    single = stages["shingle_join"](spark, cleaned, DATA).cache()
    rows = {r.doc_id: r.text for r in cleaned.collect() if r.doc_id is not None}
    low = brute_components({i: shingle_set(t) for i, t in rows.items()})
    assert sorted(r.doc_id for r in single.collect() if r.doc_id is not None) == sorted(i for i in low if low[i] == i)
    assert single.where("doc_id IS NULL").count() == 1

    masked = stages["pii"](spark, single, DATA).cache()
    before, after = (Counter(r.doc_id for r in df.collect()) for df in (single, masked))
    assert before == after and masked.columns == docs.columns
    assert masked.where(F.length("text") != F.col("n_chars")).count() == 0

    packed = stages["packing"](spark, masked, DATA).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in masked.collect())
    assert sum(r.length for r in packed) == want
    filled = Counter()
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024 and len(filled) <= np.ceil(want / 1024) * 1.1 + 1


def test_short_lines_on_many_sites_go(spark):
    rows = [(i, f"own words {i}\nAll rights reserved.", "en", f"s{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_shared_lines(spark, docs, DATA).collect()}
    assert got == {i: rows[0][1] if i == 0 else f"own words {i}" for i in range(20)}


def test_repeated_ids(spark):
    first, second, third = (" ".join(f"{w}{i}" for i in range(40)) for w in "xyz")
    rows = [(5, first), (5, second), (5, second), (9, first), (9, third), (2, third + " more"), (7, ""), (7, None), (8, "ab"),
            (8, "ab"), (6, first + " end"), (6, first + " fin")]
    docs = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), DATA)
    assert got.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in got.collect())
    assert found.pop((7, None), 0) + found.pop((7, ""), 0) == 1
    assert found == Counter([(5, first), (5, second), (2, third + " more"), (8, "ab")])
    own = spark.createDataFrame([(4, first), (4, second), (3, first + " end")], "doc_id long, text string")
    own = corpus_pipeline.drop_near_duplicates(spark, own, DATA)
    assert Counter((r.doc_id, r.text) for r in own.collect()) == Counter([(3, first + " end"), (4, second)])


def test_run_equals_the_stages(spark):
    before = spark.conf.getAll
    got = Counter((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, DATA).collect())
    assert spark.conf.getAll == before
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert got == Counter((r.doc_id, r.piece, r.ids_crc32) for r in docs.collect())
