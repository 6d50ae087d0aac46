"""Splitting sentences into words."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of letters or digits in any script.
WORD = r"[\p{L}\p{N}]+"

Segmenter = Callable[[str], list[str]]


def tokenize(col: str | Column) -> Column:
    """Lower-cased words of the whole text as an array (JVM-side, no Python)."""
    text = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def segment_with(segmenter: Segmenter) -> Callable[[str | Column], Column]:
    """Array-of-words column from a Python segmenter, run over Arrow batches.

    For languages written without spaces, where ``tokenize`` cannot find words.
    """
    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else list(segmenter(t)))

    return split


def longest_match(words: Iterable[str]) -> Segmenter:
    """Segmenter that takes the longest dictionary word at each place.

    Runs of ASCII letters or digits stay whole; any other single character not
    covered by the dictionary becomes its own word.
    """
    known = frozenset(w.lower() for w in words)
    reach = max(map(len, known), default=1)

    def segment(sentence: str) -> list[str]:
        text, out, at = sentence.lower(), [], 0
        while at < len(text):
            end = at + 1
            if text[at].isascii() and text[at].isalnum():
                while end < len(text) and text[end].isascii() and text[end].isalnum():
                    end += 1
            else:
                end = next((stop for stop in range(min(len(text), at + reach), at + 1, -1)
                            if text[at:stop] in known), at + 1)
            if any(c.isalnum() for c in text[at:end]):
                out.append(text[at:end])
            at = end
        return out

    return segment


def register_split_keywords(spark: SparkSession, segmenter: Segmenter | None = None,
                            name: str = "splitKeywords") -> None:
    """SQL function: a sentence as its words joined by commas (empty text when it has none).

    Without a segmenter it is a SQL expression that Spark inlines.
    """
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    if segmenter is None:
        spark.sql(f"CREATE TEMPORARY FUNCTION {name}(sentence STRING) RETURNS STRING "
                  f"RETURN array_join(regexp_extract_all(lower(sentence), r'{WORD}', 0), ',')")
        return

    @F.pandas_udf("string")
    def joined(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else ",".join(segmenter(t)))

    spark.udf.register(name, joined)


def explode_words(df: DataFrame, text: str, word: str = "keyword",
                  split: Callable[[str | Column], Column] = tokenize) -> DataFrame:
    """One row per word, the text column replaced; texts without words give no rows."""
    rest = [F.col(c) for c in df.columns if c != text]
    return df.select(F.explode(split(F.col(text))).alias(word), *rest)
