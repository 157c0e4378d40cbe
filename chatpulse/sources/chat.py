"""Chat history over the provided tables.

An event is a message sent: it has a user and a time. The document with the
event's id is its text; the text of an event without a document is null.
Document ids are unique, so what needs no text reads the events alone, and
what needs only text reads the documents alone; neither moves a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """``user, timestamp`` of every event."""
    return _events(spark, folder).select(
        F.col("user_id").cast("string").alias("user"), F.col("ts").alias("timestamp")
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, message`` of every document."""
    return _documents(spark, folder).select("doc_id", F.col("text").alias("message"))


def chat_view(spark: SparkSession, folder: str, sort_texts: bool = True, **from_text: Column) -> DataFrame:
    """``user, timestamp, message`` of every event.

    Named expressions over ``message`` take the place of the message: they are
    computed beside the documents, so the join moves their results and not the
    texts. The join is a plain left join, so adaptive execution may split a hot
    id, or broadcast a side whose measured size is small. Without ``sort_texts``
    the texts pass by a partition's events, which are held in memory, so no text is
    sorted and none spilled; a hot id is split there as well.
    """
    spoken = texts(spark, folder)
    if from_text:
        spoken = spoken.select(
            "doc_id", *(column.alias(name) for name, column in from_text.items())
        )
    events = _events(spark, folder).select("event_id", "user_id", "ts")
    events = events if sort_texts else events.hint("shuffle_hash")
    joined = events.join(spoken, F.col("event_id") == F.col("doc_id"), "left")
    return joined.select(
        F.col("user_id").cast("string").alias("user"),
        F.col("ts").alias("timestamp"),
        *(name for name in spoken.columns if name != "doc_id"),
    )
