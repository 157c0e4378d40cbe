"""Ingest: raw chat traffic -> message payloads on a topic, and what is no message beside it.

    python -m chatpulse.plans.ingest_layer --raw D --topic-folder T --rejects R --checkpoints C
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from chatpulse.operators.ingest import (
    OUTCOMES,
    chat_lines,
    encode_payload,
    judged_lines,
    judged_pieces,
    messages_of,
    parse_chat_lines,
    set_aside,
)
from chatpulse.settings import job_session
from chatpulse.sinks.logs import append_epoch, read_epochs
from chatpulse.sources import raw, topics
from chatpulse.sources.topics import publish, publish_stream
from chatpulse.streaming.run import finish, start, supervise

#: Counts of a trigger: all lines, and those of each outcome.
COUNTS = "lines bigint, accepted bigint, rejected bigint, other bigint"


def payloads_from_chunks(chunks: DataFrame, chunk: str = "chunk", begins: str | None = None) -> DataFrame:
    return encode_payload(parse_chat_lines(chat_lines(chunks, chunk, begins)))


def ingest(
    chunks: DataFrame,
    target: tuple[str, Mapping[str, str]],
    aside: str | None = None,
    begins: str | None = None,
) -> None:
    """Publishes the messages of a batch; every other line or piece goes to the folder ``aside``."""
    publish(payloads_from_chunks(chunks, begins=begins), target)
    if aside is not None:
        set_aside(judged_pieces(chunks, begins=begins)).write.mode("append").parquet(aside)


def start_ingest(
    judged: DataFrame, target: tuple[str, Mapping[str, str]], checkpoint: str, **trigger
) -> StreamingQuery:
    """Publishes the messages of a stream of judged lines."""
    return publish_stream(encode_payload(messages_of(judged)), target, checkpoint, **trigger)


def _outcomes() -> list[Column]:
    """The metrics of a trigger, as aggregates over ``kind``."""
    made = [F.count(F.lit(1)).alias("lines")]
    for outcome in dict.fromkeys(OUTCOMES.values()):
        kinds = [kind for kind, of in OUTCOMES.items() if of == outcome]
        made.append(F.count(F.when(F.col("kind").isin(kinds), 1)).alias(outcome))
    return made


def start_rejects(judged: DataFrame, folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keeps every line of a stream that is no message, and how many of each outcome a trigger had.

    The counts are observed while the rejects are written, in the same pass. Each
    trigger has folders of its own, which it replaces if it runs again.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        seen = Observation()
        append_epoch(set_aside(batch.observe(seen, *_outcomes())), f"{folder}/lines", epoch)
        counts = batch.sparkSession.createDataFrame([tuple(seen.get[n] for n in COUNTS.replace(" bigint", "").split(", "))], COUNTS)
        append_epoch(counts, f"{folder}/counts", epoch)

    return start(judged.writeStream.foreachBatch(write), "append", checkpoint, **trigger)


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """``line, kind, epoch`` of every line that was no message."""
    return read_epochs(spark, f"{folder}/lines", "line string, kind string")


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``lines, accepted, rejected, other, epoch`` of every trigger."""
    return read_epochs(spark, f"{folder}/counts", COUNTS)


def start_lines(
    lines: DataFrame, target: tuple[str, Mapping[str, str]], rejects: str, checkpoints: str, **trigger
) -> list[StreamingQuery]:
    """Messages to the topic, everything else and the counts beside it."""
    judged = judged_lines(lines)
    return [
        start_ingest(judged, target, f"{checkpoints}/messages", **trigger),
        start_rejects(judged, rejects, f"{checkpoints}/rejects", **trigger),
    ]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of raw files")
    parser.add_argument("--rejects", required=True, help="folder for lines that are no messages, and the counts")
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--topic-folder", help="folder of Parquet files with a value column")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--every", help="trigger interval, such as '5 seconds'")
    parser.add_argument("--available-now", action="store_true")
    given = parser.parse_args(arguments)
    if bool(given.topic_folder) == bool(given.servers and given.topic):
        parser.error("give --topic-folder, or --servers and --topic")
    spark = job_session("chat ingest")
    target = topics.file_target(given.topic_folder) if given.topic_folder else topics.kafka_target(given.servers, given.topic)
    trigger = {"available_now": True} if given.available_now else {"every": given.every}
    queries = start_lines(raw.stream_raw(spark, given.raw), target, given.rejects, given.checkpoints, **trigger)
    if given.available_now:
        finish(*queries)
        total = read_counts(spark, given.rejects).agg(*(F.sum(n) for n in ("lines", "accepted", "rejected"))).first()
        print("{} lines: {} messages, {} rejected".format(*total))
    else:
        supervise(spark, queries)


if __name__ == "__main__":
    main()
