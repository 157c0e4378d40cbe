"""Streaming jobs: topic -> keyed tables, console or archive.

    python -m chatpulse.plans.speed_layer tables  --topic-folder D --tables T --checkpoints C
    python -m chatpulse.plans.speed_layer console --servers H:P --topic N --checkpoints C
    python -m chatpulse.plans.speed_layer archive --servers H:P --topic N --archive A --checkpoints C
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from chatpulse import schemas
from chatpulse.functions.text import TOXIC_WORDS
from chatpulse.operators import activity
from chatpulse.operators.ingest import decode_payload
from chatpulse.settings import job_session
from chatpulse.sinks.connectors import CASSANDRA, parse_names, split_writer, store_writer
from chatpulse.sinks.keyed import KeyedTable
from chatpulse.sources import topics
from chatpulse.streaming import metrics
from chatpulse.streaming.run import finish, late_rows, supervise


def keyed(tables: str, table: schemas.ResultTable) -> KeyedTable:
    return KeyedTable(f"{tables}/{table.name}", table)


def _start_keyed(
    metric: DataFrame, table: KeyedTable, checkpoint: str, output_mode: str, trigger: dict
) -> StreamingQuery:
    spark = metric.sparkSession
    table.create_if_absent(spark)
    writer = table.writer(table.generation_for(spark, checkpoint))
    return metrics.start_to(metric, writer, checkpoint, output_mode, **trigger)


def start_window_table(
    flagged: DataFrame,
    tables: str,
    checkpoints: str,
    *,
    window: str = activity.WINDOW_LENGTH,
    watermark: str = metrics.WATERMARK,
    **trigger,
) -> StreamingQuery:
    return _start_keyed(
        metrics.window_counts(flagged, window, watermark),
        keyed(tables, schemas.WINDOW_COUNTS),
        f"{checkpoints}/windows", "update", trigger,
    )


def start_user_table(
    flagged: DataFrame, tables: str, checkpoints: str, **trigger
) -> StreamingQuery:
    return _start_keyed(
        metrics.user_counts(flagged),
        keyed(tables, schemas.USER_COUNTS),
        f"{checkpoints}/users", "update", trigger,
    )


def start_minute_table(
    messages: DataFrame,
    tables: str,
    checkpoints: str,
    *,
    watermark: str = metrics.WATERMARK,
    **trigger,
) -> StreamingQuery:
    """The message rate, per aligned minute."""
    return _start_keyed(
        metrics.messages_per_minute(messages, watermark=watermark),
        keyed(tables, schemas.MINUTE_ACTIVITY),
        f"{checkpoints}/minutes", "update", trigger,
    )


def start_tables(
    payloads: DataFrame,
    tables: str,
    checkpoints: str,
    *,
    words: Sequence[str] = TOXIC_WORDS,
    time_source: str = "processing",
    window: str = activity.WINDOW_LENGTH,
    watermark: str = metrics.WATERMARK,
    **trigger,
) -> list[StreamingQuery]:
    """The four metrics from two queries, in two keyed tables.

    With event time a third query keeps the messages that have no readable time,
    and so count for no window, in ``<tables>/untimed``.
    """
    flagged = metrics.flagged_messages(payloads, words=words, time_source=time_source)
    queries = [
        start_window_table(flagged, tables, checkpoints, window=window, watermark=watermark, **trigger),
        start_user_table(flagged, tables, checkpoints, **trigger),
    ]
    if time_source == "event":
        queries.append(
            metrics.start_untimed(payloads, untimed_folder(tables), f"{checkpoints}/untimed", **trigger)
        )
    return queries


def start_ranking_table(
    flagged: DataFrame,
    tables: str,
    checkpoints: str,
    ranked: schemas.ResultTable = schemas.USER_ACTIVITY,
    **trigger,
) -> StreamingQuery:
    """The whole ranking after every trigger, in complete mode.

    Each trigger writes all users, so this is for dashboards of bounded rooms;
    ``read_ranking`` gives the same from the users that a trigger changed.
    """
    metric = metrics.toxic_user_ranking if ranked is schemas.TOXIC_USERS else metrics.user_ranking
    return _start_keyed(
        metric(flagged), keyed(f"{tables}/ranking", ranked), f"{checkpoints}/ranking-{ranked.name}", "complete", trigger
    )


def read_ranking_table(
    spark: SparkSession, tables: str, ranked: schemas.ResultTable = schemas.USER_ACTIVITY
) -> DataFrame:
    """The last trigger's ranking, best first."""
    stored = keyed(f"{tables}/ranking", ranked)
    rows = stored.newest_epoch(spark, stored.last_generation(spark))
    return activity.rank_by(rows, ranked.values[0].name, ranked.key.name)


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``window_start, window_end`` and the counts of the windows still held by a window query.

    Reads the state as of the last trigger, from the checkpoint of a query that
    ``start_window_table`` started, be it stopped or running.
    """
    state = spark.read.format("statestore").load(f"{checkpoint}/windows")
    # The state's own names repeat; its fields stand in the order of the counts.
    counts = T.StructType([T.StructField(f.name, T.LongType()) for f in schemas.WINDOW_COUNTS.values])
    window = F.col("key").cast("struct<window:struct<start:timestamp,end:timestamp>>")["window"]
    return state.select(
        window["start"].alias("window_start"), window["end"].alias("window_end"), F.col("value").cast(counts).alias("value")
    ).select("window_start", "window_end", "value.*")


def untimed_folder(tables: str) -> str:
    return f"{tables}/untimed"


RANKED = {
    schemas.USER_ACTIVITY.name: activity.total_part,
    schemas.TOXIC_USERS.name: activity.toxic_part,
}


def read_windows(
    spark: SparkSession,
    tables: str,
    table: schemas.ResultTable = schemas.WINDOW_COUNTS,
    time_source: str = "processing",
) -> DataFrame:
    """Window counts: of the newest generation, or with event time of all of them.

    A rebuilt stream counts old messages in other windows of processing time; its
    windows of event time are the same, and those it lacks keep their counts.
    """
    stored = keyed(tables, table)
    if time_source == "event":
        return stored.largest(spark)
    return stored.latest(spark, stored.last_generation(spark))


def read_user_counts(spark: SparkSession, tables: str) -> DataFrame:
    return keyed(tables, schemas.USER_COUNTS).latest(spark)


def read_ranking(
    spark: SparkSession, tables: str, ranked: schemas.ResultTable = schemas.USER_ACTIVITY
) -> DataFrame:
    """All users by messages or by toxic messages, ranked as they are read.

    The stream writes only the users a trigger changed; a ranking kept by the
    stream would write all of them each time, and lose its order on the way.
    """
    counts = RANKED[ranked.name](read_user_counts(spark, tables))
    return activity.rank_by(counts, ranked.values[0].name, ranked.key.name)


def start_cassandra(
    payloads: DataFrame,
    keyspace: str,
    checkpoints: str,
    *,
    words: Sequence[str] = TOXIC_WORDS,
    time_source: str = "processing",
    window: str = activity.WINDOW_LENGTH,
    watermark: str = metrics.WATERMARK,
    form: str = CASSANDRA,
    names: Mapping[str, str] | None = None,
    **trigger,
) -> list[StreamingQuery]:
    """The four metrics in four outside tables with 32-bit counts, two per query."""

    def to(table: schemas.ResultTable):
        return store_writer(form, keyspace, table, names)

    flagged = metrics.flagged_messages(payloads, words=words, time_source=time_source)
    return [
        metrics.start_to(
            metrics.window_counts(flagged, window, watermark),
            split_writer(to(schemas.WINDOW_ACTIVITY), to(schemas.TOXIC_WINDOW_ACTIVITY)),
            f"{checkpoints}/windows", **trigger,
        ),
        metrics.start_to(
            metrics.user_counts(flagged),
            split_writer(to(schemas.USER_ACTIVITY), to(schemas.TOXIC_USERS)),
            f"{checkpoints}/users", **trigger,
        ),
    ]


def start_consoles(
    payloads: DataFrame,
    checkpoints: str,
    *,
    words: Sequence[str] = TOXIC_WORDS,
    time_source: str = "processing",
    window: str = activity.WINDOW_LENGTH,
    watermark: str = metrics.WATERMARK,
    **trigger,
) -> list[StreamingQuery]:
    """Changed windows, and the two full user rankings, on standard output."""
    flagged = metrics.flagged_messages(payloads, words=words, time_source=time_source)
    trigger = trigger or {"every": "5 seconds"}
    return [
        metrics.start_console(
            metrics.window_counts(flagged, window, watermark), f"{checkpoints}/windows", **trigger
        ),
        metrics.start_console(
            metrics.user_ranking(flagged), f"{checkpoints}/users", "complete", **trigger
        ),
        metrics.start_console(
            metrics.toxic_user_ranking(flagged),
            f"{checkpoints}/toxic_users", "complete", **trigger,
        ),
    ]


def start_archives(
    payloads: DataFrame, archive: str, checkpoints: str, rejected: str | None = None, **trigger
) -> list[StreamingQuery]:
    """The archive, and beside it the payloads that are no messages."""
    rejected = rejected or f"{archive.rstrip('/')}-rejected"
    return [
        metrics.start_archive(payloads, archive, f"{checkpoints}/archive", **trigger),
        metrics.start_quarantine(payloads, rejected, f"{checkpoints}/rejected", **trigger),
    ]


def _arguments(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["tables", "console", "archive"])
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--tables", help="folder of the result tables")
    parser.add_argument("--keyspace", help="write to tables of a store instead")
    parser.add_argument("--table-names", help="names there: ours=theirs,...; needs --keyspace")
    parser.add_argument("--store", default=CASSANDRA, help="data source of the store")
    parser.add_argument("--archive", help="folder of JSON lines")
    parser.add_argument("--rejected", help="folder of payloads that are no messages")
    parser.add_argument("--show-rate", action="store_true", help="print messages per minute")
    parser.add_argument("--topic-folder", help="folder of Parquet files with a value column")
    parser.add_argument("--max-files-per-trigger", type=int)
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--words", help="toxic words, separated by commas")
    parser.add_argument("--time-source", choices=["processing", "event"], default="processing")
    parser.add_argument("--window", default=activity.WINDOW_LENGTH, help="length of a window")
    parser.add_argument("--watermark", default=metrics.WATERMARK, help="how late a message may be")
    parser.add_argument("--every", help="trigger interval, such as '5 seconds'")
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--stall-seconds", type=float, help="end if a query reports nothing for so long")
    given = parser.parse_args(arguments)
    if bool(given.topic_folder) == bool(given.servers and given.topic):
        parser.error("give --topic-folder, or --servers and --topic")
    needed = {"tables": given.tables or given.keyspace, "archive": given.archive}
    if not needed.get(given.job, True):
        parser.error(f"{given.job} needs a target")
    if given.table_names and not given.keyspace:
        parser.error("--table-names without --keyspace would name nothing")
    if given.tables and given.keyspace:
        parser.error("give --tables or --keyspace")
    return given


def main(arguments: list[str] | None = None) -> None:
    given = _arguments(arguments)
    spark = job_session(f"chat speed layer: {given.job}")
    if given.topic_folder:
        payloads = topics.read_files(spark, given.topic_folder, given.max_files_per_trigger)
    else:
        payloads = topics.read_kafka(
            spark, given.servers, given.topic,
            max_offsets_per_trigger=given.max_offsets_per_trigger,
            min_partitions=given.min_partitions,
        )
    trigger = {"available_now": True} if given.available_now else {"every": given.every}
    words = given.words.split(",") if given.words else TOXIC_WORDS
    rules = {
        "words": words, "time_source": given.time_source,
        "window": given.window, "watermark": given.watermark,
    }
    if given.job == "archive":
        queries = start_archives(
            payloads, given.archive, given.checkpoints, given.rejected, **trigger
        )
        if given.show_rate:
            messages = metrics.stamp(decode_payload(payloads), given.time_source)
            queries.append(
                metrics.start_console(
                    metrics.messages_per_minute(messages, watermark=given.watermark),
                    f"{given.checkpoints}/rate", **trigger,
                )
            )
    elif given.job == "console":
        trigger = trigger if given.available_now or given.every else {}
        queries = start_consoles(payloads, given.checkpoints, **rules, **trigger)
    elif given.keyspace:
        queries = start_cassandra(
            payloads, given.keyspace, given.checkpoints,
            form=given.store, names=parse_names(given.table_names), **rules, **trigger,
        )
    else:
        queries = start_tables(payloads, given.tables, given.checkpoints, **rules, **trigger)
    if given.available_now:
        finish(*queries)
    else:
        supervise(spark, queries, given.stall_seconds)
    late = sum(map(late_rows, queries))
    if late:
        print(f"{late} rows came after the watermark and are in no window; widen --watermark")


if __name__ == "__main__":
    main()
