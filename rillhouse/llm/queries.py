"""The numbered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, chat, hard_negatives, language, lines, packing, pii, shingle_join,
               sites, token_counts, topk, vector_dedup)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Key of the pseudonyms in the queries; a deployment passes its own secret.
PSEUDONYM_KEY = "example key, to be replaced"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_site_quality(spark, sf):
    """Hosts are the sources; their paths are the language sections."""
    return sites.score(table(spark, sf, "documents"), table(spark, sf, "labels"),
                       F.col("source"), F.col("lang"))


@query
def op2_pivot_topk(spark, sf):
    return topk.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op3_bpe_roundtrip(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf, "documents"), path), path))


@query
def op4_vector_dedup(spark, sf):
    return vector_dedup.link(table(spark, sf, "embeddings"), cosine=0.98)


@query
def op5_shingle_join(spark, sf):
    return shingle_join.near_duplicates(table(spark, sf, "documents"), words=5, percent=75)


@query
def op6_pseudonyms(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    masked = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return masked.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


@query
def op7_slack_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


@query
def op8_line_spread(spark, sf):
    done = lines.drop_boilerplate(table(spark, sf, "documents"))
    return done.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                       F.col("__kept").alias("kept"))


@query
def op9_language(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    found = language.found_name(docs)
    return language.identify(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), language.held_out().alias("held_out"),
        F.col(f"{found}.lang_pred").alias("lang_pred"), F.col(f"{found}.score").alias("score"))


@query
def op10_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query
def op11_hard_negatives(spark, sf):
    """Labels of the rows divisible by seven are moved on by one before anything else."""
    table_ = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table_, F.col("vec_id") % 100 == 0, label)


@query
def op12_chat_format(spark, sf):
    """All conversations and one more, number -7, whose texts look like the template's marks."""
    asked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_log(chat.as_events(rows.unionByName(asked))))


@query
def op13_token_alignment(spark, sf):
    done = alignment.align(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.coalesce(F.sha2(F.col("groups"), 256), F.lit(""))
    return done.withColumn("groups_sha256", digest).drop("groups")
