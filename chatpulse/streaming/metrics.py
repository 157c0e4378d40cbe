"""The metric streams.

A stream keeps total and toxic counts of a key side by side. Counting toxic
messages in a query of their own would put the toxicity filter below the
watermark, where only toxic messages move event time and finished windows stay
in the state; it would also read the topic twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from chatpulse.functions.text import TOXIC_WORDS
from chatpulse.operators import activity
from chatpulse.operators.ingest import decode_payload, quarantine, stamp_archive_time
from chatpulse.sinks.connectors import BatchWriter
from chatpulse.streaming.run import start

WATERMARK = "10 seconds"


def stamp(messages: DataFrame, time_source: str) -> DataFrame:
    """Sets ``timestamp`` to the trigger's time, or to the time in the message.

    With processing time all messages of a trigger share one time stamp.
    With event time a message whose time is missing or unreadable gets null and
    belongs to no window, though it still counts for its user.
    """
    if time_source == "processing":
        time = F.current_timestamp()
    elif time_source == "event":
        time = F.try_to_timestamp("timestamp")
    else:
        raise ValueError(f"time source is 'processing' or 'event', not {time_source!r}")
    return messages.withColumn("timestamp", time)


def untimed(messages: DataFrame) -> DataFrame:
    """Messages whose own time is missing or unreadable: they belong to no window of event time."""
    return messages.filter(F.try_to_timestamp("timestamp").isNull())


def flagged_messages(
    payloads: DataFrame,
    *,
    words: Sequence[str] = TOXIC_WORDS,
    time_source: str = "processing",
    drop_malformed: bool = False,
) -> DataFrame:
    """``user, message, timestamp, is_toxic`` from a topic."""
    messages = stamp(decode_payload(payloads, drop_malformed), time_source)
    return activity.flag_toxic(messages, words)


def window_counts(
    flagged: DataFrame,
    length: str = activity.WINDOW_LENGTH,
    watermark: str = WATERMARK,
) -> DataFrame:
    return activity.window_counts(flagged.withWatermark("timestamp", watermark), length)


def messages_per_minute(messages: DataFrame, *, watermark: str = WATERMARK) -> DataFrame:
    return activity.messages_per_minute(messages.withWatermark("timestamp", watermark))


def user_counts(flagged: DataFrame) -> DataFrame:
    """Running counts per user; a user never leaves the state."""
    return activity.user_counts(flagged)


def user_ranking(flagged: DataFrame) -> DataFrame:
    """All users by messages; a sorted result needs complete mode."""
    return activity.rank_by(activity.user_activity(flagged), "nb_messages", "user")


def toxic_user_ranking(flagged: DataFrame) -> DataFrame:
    return activity.rank_by(activity.toxic_users(flagged), "nb_toxic_messages", "user")


def start_to(
    metric: DataFrame, writer: BatchWriter, checkpoint: str, output_mode: str = "update", **trigger
) -> StreamingQuery:
    """Hands every trigger's changed rows (or, in complete mode, all rows) to a writer."""
    return start(metric.writeStream.foreachBatch(writer), output_mode, checkpoint, **trigger)


def start_console(
    metric: DataFrame, checkpoint: str, output_mode: str = "update", **trigger
) -> StreamingQuery:
    """Prints every trigger's rows in full width."""
    writer = metric.writeStream.format("console").option("truncate", "false")
    return start(writer, output_mode, checkpoint, **trigger)


def start_archive(
    payloads: DataFrame, folder: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Appends decoded messages with their arrival time as JSON lines.

    Payloads that do not decode are left out, as a record without sender and text
    tells nothing; ``start_quarantine`` keeps them. The checkpoint and the file
    log together keep every message once over restarts.
    """
    records = stamp_archive_time(decode_payload(payloads, drop_malformed=True))
    writer = records.writeStream.format("json").option("ignoreNullFields", "false")
    return start(writer.option("path", folder), "append", checkpoint, **trigger)


def start_quarantine(
    payloads: DataFrame, folder: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Appends the payloads that do not decode, as they came, to a folder topic.

    With ``start_archive`` every payload is in one of the two outputs once.
    """
    writer = quarantine(payloads).writeStream.format("parquet").option("path", folder)
    return start(writer, "append", checkpoint, **trigger)


def start_untimed(
    payloads: DataFrame, folder: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Appends the messages without a readable time, broken payloads among them, as JSON lines."""
    rows = untimed(decode_payload(payloads))
    writer = rows.writeStream.format("json").option("ignoreNullFields", "false")
    return start(writer.option("path", folder), "append", checkpoint, **trigger)
