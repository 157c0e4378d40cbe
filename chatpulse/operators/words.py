"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatpulse.functions.text import ascii_tokens
from chatpulse.operators.activity import rank_by


def words(messages: DataFrame, *keep: str) -> DataFrame:
    """One row per non-empty token, beside the columns named."""
    return messages.select(
        *keep, F.explode(ascii_tokens(F.col("message"))).alias("word")
    ).filter(F.col("word") != "")


def word_counts(messages: DataFrame) -> DataFrame:
    """``word, count``; counted within each task before the shuffle."""
    return words(messages).groupBy("word").agg(F.count("*").alias("count"))


def top_words(counts: DataFrame, n: int = 100) -> DataFrame:
    return rank_by(counts, "count", "word").limit(n)
