"""Totals, means and the long metric formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _mean_or_zero(measure: str) -> Column:
    return F.coalesce(F.avg(measure), F.lit(0.0))


def total_messages(messages: DataFrame) -> DataFrame:
    return messages.agg(F.count("*").alias("total_messages"))


def average_messages_per_user(users: DataFrame) -> DataFrame:
    """Mean of the counts per user, 0.0 over no users."""
    return users.agg(_mean_or_zero("nb_messages").alias("average_messages_per_user"))


def global_stats(users: DataFrame) -> DataFrame:
    """``metric_name, value`` rows, from one aggregate over the counts per user."""
    totals = users.agg(
        F.coalesce(F.sum("nb_messages"), F.lit(0)).cast("double").alias("total"),
        _mean_or_zero("nb_messages").alias("mean"),
    )
    return totals.select(
        F.stack(
            F.lit(2),
            F.lit("total_messages"), F.col("total"),
            F.lit("average_messages_per_user"), F.col("mean"),
        ).alias("metric_name", "value")
    )


def metric_rows(counts: DataFrame, key: str, measure: str, metric: str) -> DataFrame:
    """``key, value, metric`` form of a keyed count."""
    return (
        counts.withColumnsRenamed({key: "key", measure: "value"})
        .withColumn("metric", F.lit(metric))
        .select("key", F.col("value").cast("bigint").alias("value"), "metric")
    )


def stats_long(users: DataFrame, words: DataFrame) -> DataFrame:
    """Counts per user and per word in one long table."""
    return metric_rows(users, "user", "nb_messages", "messages_per_user").unionByName(
        metric_rows(words, "word", "count", "top_words")
    )
