"""Cross-site boilerplate lines by the number of distinct sites that show them.

Per line hash a HyperLogLog sketch of sites is built, merged by aggregation. Lines whose estimate
is clearly over the threshold are boilerplate, those clearly under are not, and for the lines near
it the distinct sites are counted exactly. A boilerplate line stays where it is met first (smallest
doc_id, then smallest line number) and goes everywhere else; a document that had words and loses
all its lines goes too (``kept`` is false).

A line is what stands between line feeds, without outer white space of any kind. A letter of a
script without spaces counts as a word. Lines of fewer than ``min_words`` words are often everyday
sentences: they are judged by ``short_sites``, a number of sites that should be well above
`X"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


#: White space inside a line, and scripts whose words stand without it.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != "\n")
UNSPACED = (r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
            r"\p{IsTibetan}]")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE))


def _need(line: Column, min_sites: int, min_words: int, short_sites: int) -> Column:
    """How many sites must show the line; null for an empty one."""
    words = F.size(F.split(line, r"\s+"))
    long = (words >= min_words) | (words + F.regexp_count(line, F.lit(UNSPACED)) >= min_words)
    return F.when(line == "", None).when(long, min_sites).otherwise(short_sites)


def boilerplate(docs: DataFrame, min_sites: int, min_words: int, site: str = "source",
                log_size: int = 10, margin: float = 0.25, short_sites: int = 20) -> DataFrame:
    """hash, first_doc, first_line of every line shown by at least ``min_sites`` sites, or
    ``short_sites`` if it is short.

    ``margin`` is the band around the threshold that is counted exactly; the sketch's standard
    error at ``log_size`` 10 is about 0.03, so the band is eight of them wide on each side.
    """
    line = _trimmed(F.col("part"))
    shown = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col(site).cast("string").alias("site"),
                         F.posexplode(_lines(F.col("text"))).alias("nth", "part"))
             .select("doc_id", "nth", "site", F.xxhash64(line).alias("hash"),
                     _need(line, min_sites, min_words, short_sites).alias("need"))
             .where("need IS NOT NULL"))
    # Documents of one site that show a line are one row, whatever their number: combined
    # before the shuffle, and a row count of one rules out most lines before any sketch.
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "nth"))).alias("first")
    spread = (shown.groupBy("hash", "need").agg(F.hll_sketch_agg("site", log_size).alias("sketch"), first)
              .withColumn("sites", F.hll_sketch_estimate("sketch")))
    likely = common.written(spread.where(F.col("sites") >= F.col("need") * (1 - margin))
                            .select("hash", "need", "sites", "first"), "spread-lines")
    near = likely.where(F.col("sites") < F.col("need") * (1 + margin))
    n_near = near.count()
    exact = (common.with_side(shown, near.select("hash"), "hash", "left_semi", n_near)
             .groupBy("hash", "need").agg(F.count_distinct("site").alias("exact"))
             .where(F.col("exact") >= F.col("need")).select("hash"))
    sure = likely.where(F.col("sites") >= F.col("need") * (1 + margin))
    agreed = sure.unionByName(near.join(exact, "hash", "left_semi"))
    return agreed.select("hash", F.col("first.doc_id").alias("first_doc"),
                         F.col("first.nth").alias("first_line"))


def drop_boilerplate(docs: DataFrame, min_sites: int = 5, min_words: int = 5,
                     site: str = "source", short_sites: int = 20) -> DataFrame:
    """The columns of ``docs`` with cleaned texts, and __n_lines, __n_removed, __kept."""
    bad = common.written(boilerplate(docs, min_sites, min_words, site, short_sites=short_sites),
                         "boilerplate")
    n_bad = bad.count()
    key, gone = (common.new_name(n, docs.columns) for n in ("row", "gone"))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    line = _trimmed(F.col("part"))
    shown = (keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("row"),
                          F.posexplode(_lines(F.col("text"))).alias("nth", "part"))
             .where(_need(line, min_sites, min_words, short_sites).isNotNull())
             .select("doc_id", "row", "nth", F.xxhash64(line).alias("hash")))
    stays = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("nth") == F.col("first_line"))
    goes = (common.with_side(shown, bad, "hash", "inner", n_bad).where(~stays)
            .groupBy("row").agg(F.collect_set("nth").alias("gone")))
    touched = common.written(goes, "line-drops")
    # Numbers in it, not rows: a row holds an array.
    n_touched = touched.agg(F.sum(F.size("gone") + 2)).first()[0] or 0
    joined = common.with_side(keyed, touched.withColumnRenamed("row", key)
                              .withColumnRenamed("gone", gone), key, "left", n_touched)
    parts = _lines(F.col("text").cast("string"))
    left = F.filter(parts, lambda part, i: ~F.array_contains(F.col(gone), i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    removed = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    return joined.select(
        *[F.col(f"`{c}`") if c != "text" else text.alias("text") for c in docs.columns],
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("__n_lines"),
        F.greatest(removed, F.lit(0)).alias("__n_removed"),
        (F.col(gone).isNull() | (_trimmed(text) != "")).alias("__kept"))
