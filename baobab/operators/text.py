"""Word count (C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(df: DataFrame, text_col: str = "value", word_col: str = "mot") -> DataFrame:
    """Lower-case, split on runs of whitespace, drop empty tokens, count.

    Whole texts are tokenised inside the scan stage (``explode`` of a
    ``split``); the count is a partial aggregate, so frequent words are
    summed per task before the shuffle by word.
    """
    words = df.select(F.explode(F.split(F.lower(F.col(text_col)), r"\s+")).alias(word_col))
    return words.filter(F.col(word_col) != "").groupBy(word_col).agg(F.count("*").alias("n"))


def top_words(df: DataFrame, k: int, text_col: str = "value", word_col: str = "mot") -> DataFrame:
    """The ``k`` most frequent words, ties broken alphabetically."""
    return word_count(df, text_col, word_col).orderBy(F.col("n").desc(), F.col(word_col)).limit(k)
