"""Small frames and file topics for the tests."""

import os
import time

from pyspark.sql import functions as F

from chatpulse.operators.ingest import encode_payload


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def texts(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "message string")


def chat(spark, *messages):
    """``user, message, timestamp`` rows; times are seconds after midnight or None."""
    data = [(u, m, s) for u, m, s in messages]
    frame = spark.createDataFrame(data, "user string, message string, s int")
    return frame.select(
        "user", "message",
        F.timestamp_seconds(F.lit(1704067200) + F.col("s")).alias("timestamp"),
    )


def add_file(spark, folder, *messages):
    """Adds one file of payloads to a file topic, later than the files there."""
    timed = chat(spark, *messages).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    )
    before = set(_parts(folder))
    encode_payload(timed.coalesce(1), "user", "message", "timestamp").write.mode(
        "append"
    ).parquet(folder)
    later = time.time() + len(before)
    for path in set(_parts(folder)) - before:
        os.utime(path, (later, later))


def _parts(folder):
    if not os.path.isdir(folder):
        return []
    return [
        os.path.join(folder, name) for name in os.listdir(folder) if name.startswith("part-")
    ]


def at(second):
    """Wall-clock text of a second after midnight."""
    return f"2024-01-01 {second // 3600:02}:{second // 60 % 60:02}:{second % 60:02}"


def counted(df):
    """``{key: count, ...}`` of a two- or three-column result, times as text."""
    key, *values = df.columns
    shown = df.select(F.col(key).cast("string").alias(key), *values)
    return {r[0]: r[1] if len(values) == 1 else tuple(r[1:]) for r in shown.collect()}
