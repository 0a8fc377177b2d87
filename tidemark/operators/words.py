"""Word counts over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per blank-separated word; two blanks in a row enclose an empty word."""
    return lines.select(F.explode(F.split(column, " ")).alias("word"))


def word_counts(
    lines: DataFrame, column: str = "value", *, containing: str | None = None
) -> DataFrame:
    """``n, word`` for every distinct word, optionally only words that contain a text.

    The test on the word runs before the count, so words that fail it are never shuffled.
    """
    words = split_words(lines, column)
    if containing is not None:
        words = words.filter(F.col("word").contains(containing))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).select("n", "word")


def rarest_first(counts: DataFrame) -> DataFrame:
    """Order by count. Most words share the lowest counts, so the word splits those ranges."""
    return counts.orderBy("n", "word")
