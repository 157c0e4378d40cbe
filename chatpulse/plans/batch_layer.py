"""Batch jobs: archive -> history -> result tables.

    python -m chatpulse.plans.batch_layer --archive A --history H --tables T
    python -m chatpulse.plans.batch_layer --archive A --history H --tables T --metric-log

With ``--keyspace`` the results also go to an outside store, under the names
that ``--table-names ours=theirs,...`` gives them.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from chatpulse import schemas
from chatpulse.operators import activity, stats, words
from chatpulse.settings import job_session
from chatpulse.sinks.connectors import CASSANDRA, parse_names, store_writer
from chatpulse.sinks.keyed import KeyedTable
from chatpulse.sinks.logs import append_metrics, append_run
from chatpulse.sources.archive import convert_archive, read_history, read_rejected

# Batch runs are the epochs of one generation.
GENERATION = 1


def result_table(tables: str, table: schemas.ResultTable) -> KeyedTable:
    return KeyedTable(f"{tables}/{table.name}", table)


def write_results(messages: DataFrame, tables: str, run: int, word_rank: int = 100) -> None:
    """Counts per user, top words and global stats of a message history.

    The counts per user are computed once: the stats read the table just
    written, which also outlives any executor. Each run writes under its number.
    """
    spark = messages.sparkSession
    known = messages.filter(F.col("user").isNotNull())

    users = result_table(tables, schemas.TOP_USERS)
    users.put(activity.user_activity(known), GENERATION, run)

    # A run of its own: a word that fell out of the list is not in it, and a run
    # that dies here leaves the list of the one before.
    ranking = words.top_words(words.word_counts(known), word_rank)
    result_table(tables, schemas.TOP_WORDS).put(ranking, GENERATION, run)

    # This run's own table, which may be empty.
    counted = users.at(spark, GENERATION, run)
    result_table(tables, schemas.GLOBAL_STATS).put(stats.global_stats(counted), GENERATION, run)


def current_users(spark: SparkSession, tables: str) -> DataFrame:
    """Counts per user of the last run, so that they agree with its statistics.

    ``latest`` of the same table shows what an upsert leaves: users of earlier
    histories stay.
    """
    return result_table(tables, schemas.TOP_USERS).newest_epoch(spark, GENERATION)


def current_words(spark: SparkSession, tables: str) -> DataFrame:
    """The top words of the last run that was whole."""
    last = result_table(tables, schemas.GLOBAL_STATS).last_epoch(spark, GENERATION)
    if last is None:
        return spark.createDataFrame([], schemas.TOP_WORDS.schema)
    return result_table(tables, schemas.TOP_WORDS).at(spark, GENERATION, last)


def previews(spark: SparkSession, tables: str, n: int = 10) -> dict[str, DataFrame]:
    """What a run shows of its results: the busiest users, the commonest words, the totals."""
    return {
        schemas.TOP_USERS.name: activity.top_users(current_users(spark, tables), n),
        schemas.TOP_WORDS.name: words.top_words(current_words(spark, tables), n),
        schemas.GLOBAL_STATS.name: result_table(tables, schemas.GLOBAL_STATS).newest_epoch(spark, GENERATION),
    }


def export_results(
    spark: SparkSession,
    tables: str,
    keyspace: str,
    form: str = CASSANDRA,
    names: Mapping[str, str] | None = None,
) -> None:
    """Upserts the last run's results into an outside store that declares 32-bit counts."""
    users = current_users(spark, tables)
    totals = result_table(tables, schemas.GLOBAL_STATS).newest_epoch(spark, GENERATION)
    ranking = current_words(spark, tables)
    for table, rows in (
        (schemas.TOP_USERS, users),
        (schemas.TOP_WORDS, ranking),
        (schemas.GLOBAL_STATS, totals),
    ):
        store_writer(form, keyspace, table, names)(rows, 0)


def next_run(spark: SparkSession, tables: str) -> int:
    stats_table = result_table(tables, schemas.GLOBAL_STATS)
    last = stats_table.last_epoch(spark, GENERATION)
    return 0 if last is None else last + 1


def run_batch(
    spark: SparkSession,
    archive: str,
    history: str,
    tables: str,
    word_rank: int = 100,
    preview: bool = False,
) -> None:
    """One full run. An aborted run is repeated under its own number."""
    for table in (schemas.TOP_USERS, schemas.GLOBAL_STATS):
        result_table(tables, table).create_if_absent(spark)
    convert_archive(spark, archive, history)
    messages = read_history(spark, history)
    write_results(messages, tables, next_run(spark, tables), word_rank)
    if preview:
        messages.filter(F.col("user").isNotNull()).show(5)
        for rows in previews(spark, tables).values():
            rows.show(truncate=False)


def run_metric_log(
    spark: SparkSession,
    archive: str,
    history: str,
    tables: str,
    run: int,
    at: str,
    preview: bool = False,
    keep_history: bool = False,
) -> None:
    """Messages and long-format metrics of one run, added to their logs.

    The archive is converted anew, so that a run logs what came since the last
    one; with ``keep_history`` a whole history is used as it is. All words are
    logged, not a top list.
    """
    convert_archive(spark, archive, history, only_if_absent=keep_history)
    messages = read_history(spark, history)
    append_run(messages, f"{tables}/messages", run)
    rows = stats.stats_long(activity.user_activity(messages), words.word_counts(messages))
    append_metrics(rows, f"{tables}/stats", run, at)
    if preview:
        messages.show(5)
        logged = spark.read.parquet(f"{tables}/stats/run={run}")
        for metric, rows_shown in (("messages_per_user", 10), ("top_words", 20)):
            one = logged.filter(F.col("metric") == metric)
            activity.rank_by(one, "value", "key").show(rows_shown)
        per_user = logged.filter("metric = 'messages_per_user'").select(F.col("value").alias("nb_messages"))
        stats.global_stats(per_user).show(truncate=False)


def export_log(
    spark: SparkSession,
    tables: str,
    run: int,
    keyspace: str,
    form: str = CASSANDRA,
    names: Mapping[str, str] | None = None,
) -> None:
    """Adds one run's messages and metrics to tables of an outside store."""
    messages = spark.read.schema(schemas.MESSAGES.schema).parquet(f"{tables}/messages/run={run}")
    logged = spark.read.schema(schemas.METRIC_LOG).option("basePath", f"{tables}/stats/run={run}")
    metrics = logged.parquet(f"{tables}/stats/run={run}").select(*schemas.METRIC_LOG.names)
    for table, rows in ((schemas.MESSAGES, messages), (schemas.METRIC_LOG_TABLE, metrics)):
        store_writer(form, keyspace, table, names)(rows, 0)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--archive", required=True, help="JSON lines")
    parser.add_argument("--history", required=True, help="Parquet folder to fill")
    parser.add_argument("--tables", required=True, help="folder of the result tables")
    parser.add_argument("--keyspace", help="also upsert the results into tables of a store")
    parser.add_argument("--table-names", help="names there: ours=theirs,...; needs --keyspace")
    parser.add_argument("--store", default=CASSANDRA, help="data source of the store")
    parser.add_argument("--word-rank", type=int, default=100)
    parser.add_argument("--metric-log", action="store_true")
    parser.add_argument("--keep-history", action="store_true", help="use a whole history as it is; needs --metric-log")
    parser.add_argument("--preview", action="store_true")
    given = parser.parse_args(arguments)
    if given.table_names and not given.keyspace:
        parser.error("--table-names without --keyspace would name nothing")
    if given.keep_history and not given.metric_log:
        parser.error("--keep-history goes with --metric-log")
    store = {"form": given.store, "names": parse_names(given.table_names)}
    spark = job_session("chat batch layer")
    if given.metric_log:
        now = datetime.now(timezone.utc)
        run = int(now.timestamp())
        run_metric_log(
            spark, given.archive, given.history, given.tables,
            run=run, at=now.strftime("%Y-%m-%d %H:%M:%S"),
            preview=given.preview, keep_history=given.keep_history,
        )
        if given.keyspace:
            export_log(spark, given.tables, run, given.keyspace, **store)
    else:
        run_batch(
            spark, given.archive, given.history, given.tables,
            given.word_rank, given.preview,
        )
        if given.keyspace:
            export_results(spark, given.tables, given.keyspace, **store)
    rejected = read_rejected(spark, given.history).count()
    if rejected:
        print(f"{rejected} archive lines were no records; read_rejected shows them")


if __name__ == "__main__":
    main()
