"""Toxic flag, counts per time window and counts per user.

Every function takes a batch or a streaming frame. Counts are partially
aggregated before they are shuffled, so a user or window that holds a third of
all rows sends at most one row per input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chatpulse.functions.text import TOXIC_WORDS, has_whole_word

WINDOW_LENGTH = "10 seconds"


def flag_toxic(messages: DataFrame, words: Sequence[str] = TOXIC_WORDS) -> DataFrame:
    """Adds ``is_toxic``; null where there is no text."""
    return messages.withColumn("is_toxic", has_whole_word(F.col("message"), words))


def toxic_only(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("is_toxic"))


def _by_window(messages: DataFrame, length: str, *counts: Column) -> DataFrame:
    grouped = messages.groupBy(F.window("timestamp", length).alias("bucket")).agg(*counts)
    return grouped.select(
        F.col("bucket.start").alias("window_start"), *grouped.columns[1:]
    )


def _by_user(messages: DataFrame, *counts: Column) -> DataFrame:
    return messages.filter(F.col("user").isNotNull()).groupBy("user").agg(*counts)


def _rows(name: str) -> Column:
    return F.count("*").alias(name)


def _toxic_rows(name: str) -> Column:
    return F.count_if("is_toxic").alias(name)


def window_activity(messages: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """``window_start, total_messages``."""
    return _by_window(messages, length, _rows("total_messages"))


def toxic_window_activity(flagged: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """``window_start, total_toxic_messages``; clean messages stop at the scan."""
    return _by_window(toxic_only(flagged), length, _rows("total_toxic_messages"))


def window_counts(flagged: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Both window metrics from one pass and one shuffle."""
    return _by_window(
        flagged, length, _rows("total_messages"), _toxic_rows("total_toxic_messages")
    )


def user_activity(messages: DataFrame) -> DataFrame:
    """``user, nb_messages``; messages without a user are left out."""
    return _by_user(messages, _rows("nb_messages"))


def toxic_users(flagged: DataFrame) -> DataFrame:
    """``user, nb_toxic_messages``."""
    return _by_user(toxic_only(flagged), _rows("nb_toxic_messages"))


def user_counts(flagged: DataFrame) -> DataFrame:
    """Both user metrics from one pass and one shuffle."""
    return _by_user(flagged, _rows("nb_messages"), _toxic_rows("nb_toxic_messages"))


def total_part(counts: DataFrame) -> DataFrame:
    """The totals of ``window_counts`` or ``user_counts``."""
    return counts.select(*counts.columns[:2])


def toxic_part(counts: DataFrame) -> DataFrame:
    """The keys of ``window_counts`` or ``user_counts`` with a toxic message."""
    key, _, toxic = counts.columns
    return counts.select(key, toxic).filter(F.col(toxic) > 0)


def messages_per_minute(messages: DataFrame) -> DataFrame:
    """``window_start, n`` over aligned minutes."""
    return _by_window(messages, "1 minute", _rows("n"))


def rank_by(counts: DataFrame, measure: str, key: str) -> DataFrame:
    """Largest first; equal counts in key order, so a cut-off is well defined."""
    return counts.orderBy(F.desc(measure), F.asc(key))


def top_users(users: DataFrame, n: int = 10) -> DataFrame:
    return rank_by(users, "nb_messages", "user").limit(n)
