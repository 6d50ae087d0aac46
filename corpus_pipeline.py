"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns what its successor reads; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillhouse.llm import common, language, lines, packing, pii, shingle_join
from rillhouse.llm.queries import PSEUDONYM_KEY


def _with_size(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any text in a language (``und``) go."""
    found = language.found_name(docs)
    known = language.identify(docs).where(F.col(f"{found}.lang_pred") != language.UNKNOWN)
    return known.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go but for their first place, and documents of nothing else go. A line
    of fewer than five words is boilerplate from 20 sites on, any other from five."""
    done = lines.drop_boilerplate(docs, short_sites=20).where("__kept")
    return _with_size(done.select(*[F.col(f"`{c}`") for c in docs.columns]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates stays; of rows of one group that
    repeat it the one with the smallest text. Rows without an id stay."""
    groups = common.written(shingle_join.near_duplicates(docs, sets=True), "near-duplicates")
    times, nth, made, sig, n, group = (common.new_name(n, docs.columns) for n in (
        "times", "nth", "made", "sig", "n", "group"))
    leads = F.col("doc_id") == F.col("component_id")
    stays = common.written(groups.where("doc_id IS NOT NULL").groupBy("doc_id")
                           .agg(F.count(F.lit(1)).alias(times), F.bool_or(leads).alias("leads"))
                           .where("leads").drop("leads"), "stays")
    kept = common.with_side(docs, stays, "doc_id", "inner", stays.count())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Rows that share an id are told apart by their sets.
    several = common.written(
        groups.where(leads).join(stays.where(F.col(times) > 1), "doc_id", "left_semi")
        .select("doc_id", F.col("sig").alias(sig), F.col("n_shingles").cast("long").alias(n),
                F.col("component").alias(group)).distinct(), "repeated-ids")
    told = (kept.where(F.col(times) > 1)
            .withColumn(made, shingle_join.signatures(F.col("text").cast("string")))
            .withColumns({sig: F.col(f"{made}.sig"), n: F.col(f"{made}.n")}))
    order = Window.partitionBy("doc_id", group).orderBy("text")
    repeated = (common.with_side(told, several, ["doc_id", sig, n], "inner", several.count())
                .withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1))
    return (kept.where(F.col(times) == 1).select(*columns)
            .unionByName(repeated.select(*columns))
            .unionByName(docs.where("doc_id IS NULL").select(*columns)))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_size(pii.pseudonymise(docs, PSEUDONYM_KEY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("shingle_join", drop_near_duplicates),
    ("pii", pseudonymise),
    ("packing", pack),
]

#: SQL can't train the first stage's network, nor permute and pack.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
