"""Windows beside the messages that came too late for them.

A stateful aggregate drops late rows and tells only how many. Here every trigger
is divided at its watermark: messages in time are counted, and the rest are kept as
they are. A trigger writes what it adds, so there is no state to lose or to evict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from chatpulse.operators import activity
from chatpulse.sinks.logs import append_epoch, read_epochs
from chatpulse.sources.folders import numbered
from chatpulse.streaming.run import start

_COUNTED = "window_start timestamp, total_messages bigint, total_toxic_messages bigint"
_MARK = "newest timestamp, previous timestamp"


def _marks(spark: SparkSession, folder: str, epoch: int):
    """The newest event times up to the trigger before this one, and up to the one before that."""
    before = [n for n in numbered(spark, f"{folder}/marks", "epoch") if n < epoch]
    if not before:
        return None, None
    mark = spark.read.schema(_MARK).parquet(f"{folder}/marks/epoch={before[-1]}").first()
    return mark["newest"], mark["previous"]


def start_split(
    flagged: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    window: str = activity.WINDOW_LENGTH,
    watermark: str = "10 seconds",
    **trigger,
) -> StreamingQuery:
    """Counts a stream of ``user, message, timestamp, is_toxic`` by window, and keeps late messages.

    A message is late if its window had ended by the watermark of the trigger before
    its own: the newest time that trigger knew of when it began, less ``watermark``.
    That is when Spark's windowed aggregate drops a row, so both give the same
    counts over the same triggers. A message without a time belongs to no window
    and is neither. A trigger that runs again replaces what it wrote.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        newest, previous = _marks(spark, folder, epoch)
        timed = batch.filter(F.col("timestamp").isNotNull())
        placed = timed.withColumn("window_end", F.window("timestamp", window)["end"])
        mark = F.lit(previous).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
        is_late = F.coalesce(F.col("window_end") <= mark, F.lit(False))
        # Read twice, and computed once.
        placed = placed.withColumn("is_late", is_late).persist()
        try:
            seen = Observation()
            late = placed.observe(seen, F.max("timestamp").alias("newest")).filter("is_late")
            append_epoch(late.drop("is_late", "window_end"), f"{folder}/late", epoch)
            counts = activity.window_counts(placed.filter("NOT is_late"), window)
            append_epoch(counts, f"{folder}/counted", epoch)
        finally:
            placed.unpersist()
        times = [t for t in (newest, seen.get["newest"]) if t is not None]
        known = spark.createDataFrame([(max(times, default=None), newest)], _MARK)
        append_epoch(known.coalesce(1), f"{folder}/marks", epoch)

    return start(flagged.writeStream.foreachBatch(write), "append", checkpoint, **trigger)


def read_counted(spark: SparkSession, folder: str) -> DataFrame:
    """``window_start, total_messages, total_toxic_messages`` of what came in time."""
    rows = read_epochs(spark, f"{folder}/counted", _COUNTED)
    return rows.groupBy("window_start").agg(
        F.sum("total_messages").alias("total_messages"), F.sum("total_toxic_messages").alias("total_toxic_messages")
    )


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """``user, message, timestamp, is_toxic, epoch`` of every message that came too late."""
    return read_epochs(spark, f"{folder}/late", "user string, message string, timestamp timestamp, is_toxic boolean")
