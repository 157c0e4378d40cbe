"""Every operator as a query over the provided tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chatpulse import schemas
from chatpulse.functions.text import has_whole_word
from chatpulse.operators import activity, ingest, stats, words
from chatpulse.plans import batch_layer, ingest_layer, speed_layer
from chatpulse.settings import work_folder
from chatpulse.sinks import declared
from chatpulse.sinks.keyed import KeyedTable
from chatpulse.sinks.logs import read_metrics
from chatpulse.sources import archive, raw, topics
from chatpulse.sources.chat import chat_view, posts, texts
from chatpulse.sources.folders import remove
from chatpulse.streaming import late, metrics
from chatpulse.streaming.run import finish, late_rows, start, supervise

Query = Callable[[SparkSession, str], DataFrame]

CATALOG: dict[str, Query] = {}


def _query(function: Query) -> Query:
    CATALOG[function.__name__] = function
    return function


def _naive(time: str) -> Column:
    return F.col(time).cast("timestamp_ntz").alias(time)


def _with_naive(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn(time, _naive(time))


def _with_iso_time(messages: DataFrame) -> DataFrame:
    return messages.withColumn("timestamp", ingest.iso_text(F.col("timestamp")))


_DERIVED: dict[tuple[str, str, str], str] = {}


def _derived(
    spark: SparkSession, folder: str, form: str, write: Callable[[str], None]
) -> str:
    """Path of the chat in another form, written once per application and folder.

    Several queries start from the same topic or archive; at full size each copy
    would be as large as the texts. A form is remembered only once its write is
    through, and written again if somebody cleaned up the shared folder.
    """
    key = (spark.sparkContext.applicationId, folder, form)
    path = _DERIVED.get(key)
    if path is None or not _is_there(spark, path):
        path = work_folder(spark, form)
        write(path)
        _DERIVED[key] = path
    return path


def _is_there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException:
        return False
    return True


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    return chat_view(spark, folder, is_toxic=has_whole_word(F.col("message")))


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return activity.user_activity(posts(spark, folder))


def _words(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_counts(texts(spark, folder))


# --- activity -----------------------------------------------------------------


@_query
def total_messages(spark, folder):
    return stats.total_messages(posts(spark, folder))


@_query
def global_activity(spark, folder):
    return activity.window_activity(posts(spark, folder))


@_query
def messages_per_minute(spark, folder):
    return activity.messages_per_minute(posts(spark, folder))


@_query
def user_activity(spark, folder):
    return _users(spark, folder)


@_query
def top_users(spark, folder):
    return activity.top_users(_users(spark, folder), 10)


# --- toxicity -----------------------------------------------------------------


@_query
def toxic_flag(spark, folder):
    return _flagged(spark, folder)


@_query
def toxic_messages(spark, folder):
    flagged = activity.flag_toxic(chat_view(spark, folder))
    return activity.toxic_only(flagged).drop("is_toxic")


@_query
def toxic_activity(spark, folder):
    return activity.toxic_window_activity(_flagged(spark, folder))


@_query
def toxic_users(spark, folder):
    return activity.toxic_users(_flagged(spark, folder))


@_query
def window_counts(spark, folder):
    return activity.window_counts(_flagged(spark, folder))


@_query
def user_counts(spark, folder):
    return activity.user_counts(_flagged(spark, folder))


# --- words --------------------------------------------------------------------


@_query
def tokens(spark, folder):
    return words.words(texts(spark, folder), "doc_id")


@_query
def word_counts(spark, folder):
    return _words(spark, folder)


@_query
def top_words(spark, folder):
    return words.top_words(_words(spark, folder), 100)


# --- statistics ---------------------------------------------------------------


@_query
def avg_messages_per_user(spark, folder):
    return stats.average_messages_per_user(_users(spark, folder))


@_query
def global_stats(spark, folder):
    return stats.global_stats(_users(spark, folder))


@_query
def stats_long(spark, folder):
    return stats.stats_long(_users(spark, folder), _words(spark, folder))


# --- ingest -------------------------------------------------------------------

GREETING = ":chat.host 001 :welcome"
KEEPALIVE = "PING :chat.host PRIVMSG #room :not a message\r\n"


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Socket chunks: a greeting and a message line each, and a keep-alive beside them."""
    lines = F.concat(
        F.lit(GREETING + "\r\n:"), "user", F.lit("!"), "user",
        F.lit("@chat.host PRIVMSG #room : "), "message", F.lit(" \r\n"),
    )
    return chat_view(spark, folder).select(
        F.explode(F.array(F.lit(KEEPALIVE), lines)).alias("chunk")
    )


@_query
def parse_chat_lines(spark, folder):
    return ingest.parse_chat_lines(ingest.chat_lines(_chunks(spark, folder)))


@_query
def ingest_mixed_chunks(spark, folder):
    """Messages that follow a keep-alive in one chunk, and lines that a chunk border cuts.

    By the last digit of the user: 5, a text that begins with a colon is cut before
    it; 6, one that begins like a keep-alive; 7, after the colon; 8, inside the line
    break; 9, the line has no text. What was accepted and what was set aside
    make up all pieces.
    """
    head = F.concat(F.lit(":"), "user", F.lit("!"), "user", F.lit("@chat.host PRIVMSG #room "))
    end = F.lit("\r\n")
    last = F.substring("user", -1, 1)
    whole = F.concat(F.lit(KEEPALIVE), head, F.lit(":"), "message", end)
    cut = {
        "5": (F.concat(F.lit(KEEPALIVE), head), F.concat(F.lit(":"), "message", end, whole)),
        "6": (F.concat(F.lit(KEEPALIVE), head, F.lit(":")), F.concat(F.lit("PING "), "message", end)),
        "7": (F.concat(F.lit(KEEPALIVE), head, F.lit(":")), F.concat("message", end)),
        "8": (F.concat(F.lit(KEEPALIVE), head, F.lit(":"), "message", F.lit("\r")), F.concat(F.lit("\n"), whole)),
        "9": (F.concat(F.lit(KEEPALIVE), head, "message", end), F.lit("")),
    }
    chunks = F.array(F.struct(whole.alias("chunk"), F.lit(True).alias("begins")))
    for digit, (first, second) in cut.items():
        pieces = F.array(
            F.struct(first.alias("chunk"), F.lit(True).alias("begins")),
            F.struct(second.alias("chunk"), F.lit(False).alias("begins")),
        )
        chunks = F.when(last == digit, pieces).otherwise(chunks)
    known = chat_view(spark, folder, message=F.length("message").cast("string")).filter(
        "user IS NOT NULL AND message IS NOT NULL"
    )
    judged = ingest.judged_pieces(known.select(F.inline(chunks)), begins="begins")
    accepted = ingest.messages_of(judged).withColumn("state", F.lit("accepted"))
    aside = ingest.set_aside(judged).select(
        F.lit(None).cast("string").alias("user"), F.col("line").alias("message"), F.col("kind").alias("state")
    )
    return accepted.unionByName(aside)


def _raw(spark: SparkSession, folder: str) -> str:
    """Path of the chat as raw files: a greeting, a keep-alive and a message line each."""

    def write(path: str) -> None:
        chunks = _chunks(spark, folder).filter("chunk IS NOT NULL")
        # A chunk's own last break is the one that the writer adds.
        raw.write_raw(chunks.select(F.regexp_replace("chunk", "\r\n\\z", "")), path)

    return _derived(spark, folder, "raw", write)


@_query
def stream_raw_lines(spark, folder):
    """Every line of raw files, as a stream reads them: none is cut."""
    path = work_folder(spark, "lines")
    judged = ingest.judged_lines(raw.stream_raw(spark, _raw(spark, folder)))
    finish(start(judged.writeStream.format("parquet").option("path", path), "append", f"{path}-checkpoint", available_now=True))
    return spark.read.schema("line string, kind string").parquet(path)


@_query
def ingest_rejects(spark, folder):
    """Lines by outcome, as observed in the triggers, and as the topic and the reject table have them."""
    text = F.when(F.col("user").endswith("7"), F.lit(" ")).otherwise(F.lit(" :"))
    line = F.concat(F.lit(":"), "user", F.lit("!"), "user", F.lit("@chat.host PRIVMSG #room"), text, "message")
    lines = chat_view(spark, folder, message=F.length("message").cast("string")).select(line.alias("line"))
    path, topic, rejects = (work_folder(spark, what) for what in ("raw", "topic", "rejects"))
    raw.write_raw(lines.union(lines.select(F.lit(GREETING))).filter("line IS NOT NULL"), path)
    finish(
        *ingest_layer.start_lines(
            raw.stream_raw(spark, path), topics.file_target(topic), rejects, f"{rejects}-checkpoints", available_now=True
        )
    )
    counts = ingest_layer.read_counts(spark, rejects)
    outcomes = ("accepted", "rejected", "other")
    observed = counts.agg(*(F.sum(outcome).alias(outcome) for outcome in outcomes), F.sum("lines").alias("lines"))
    observed = observed.select(
        F.inline(F.array(*(F.struct(F.lit(o).alias("outcome"), F.col(o).alias("n_observed"), "lines") for o in outcomes)))
    )
    kept = ingest_layer.read_rejects(spark, rejects).select(
        F.create_map(*(F.lit(x) for pair in ingest.OUTCOMES.items() for x in pair))[F.col("kind")].alias("outcome")
    )
    sent = spark.read.schema(topics.VALUE).parquet(topic).select(F.lit("accepted").alias("outcome"))
    stored = kept.union(sent).groupBy("outcome").agg(F.count("*").alias("n_stored"))
    return observed.join(stored, "outcome", "left").select(
        "outcome", "n_observed", F.coalesce("n_stored", F.lit(0)).alias("n_stored"), F.col("lines").alias("n_lines")
    )


@_query
def ingest_to_topic(spark, folder):
    path = work_folder(spark, "topic")
    ingest_layer.ingest(_chunks(spark, folder), topics.file_target(path))
    return ingest.decode_payload(spark.read.schema(topics.VALUE).parquet(path))


@_query
def payload_encode(spark, folder):
    payloads = ingest.encode_payload(chat_view(spark, folder))
    return ingest.decode_payload(payloads).drop("timestamp")


@_query
def payload_decode(spark, folder):
    return ingest.decode_payload(ingest.encode_payload(chat_view(spark, folder)))


@_query
def payload_foreign(spark, folder):
    """Payloads that another program wrote: blanks, escapes, numbers, nested and unknown fields."""
    nested = F.concat(
        F.lit('{ "user": '), "user", F.lit(', "message": {"id": '), "user",
        F.lit(', "tags": ["a", 1.5, null]}, "room": [true], "timestamp": "\\u0032024-01-01T00:00:00" }'),
    )
    escaped = F.concat(
        F.lit('{"timestamp":null,"message":"tab\\tquote\\"slash\\/ \\u00e9\\ud83d\\ude00 '), "user",
        F.lit('","user":"'), "user", F.lit('"}'),
    )
    known = posts(spark, folder).filter("user IS NOT NULL")
    payload = F.when(F.col("user").cast("bigint") % 2 == 0, nested).otherwise(escaped)
    return ingest.decode_payload(known.select(payload.cast("binary").alias("value")))


def _partly_broken(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of the chat, those of users whose name ends in 7 broken."""
    broken = F.when(F.col("user").endswith("7"), F.lit("x")).otherwise(F.lit(""))
    return chat_view(spark, folder).select(
        F.concat(broken.cast("binary"), ingest.encoded("user", "message")).alias("value")
    )


@_query
def payload_quarantine(spark, folder):
    """Payload counts by state, after the JSON of some users was broken."""
    payloads = ingest.flag_malformed(_partly_broken(spark, folder))
    return payloads.groupBy("is_malformed").agg(F.count("*").alias("n"))


def _archive(spark: SparkSession, folder: str) -> str:
    """Path of the chat as an archive of JSON lines."""

    def write(path: str) -> None:
        archive.write_archive(_with_iso_time(chat_view(spark, folder)), path)

    return _derived(spark, folder, "archive", write)


@_query
def archive_roundtrip(spark, folder):
    history = work_folder(spark, "history")
    archive.convert_archive(spark, _archive(spark, folder), history)
    return _with_naive(archive.read_history(spark, history), "timestamp")


@_query
def archive_incremental(spark, folder):
    """Lines that each of three conversions read, and the history after it; the archive grows in between."""
    source, history = work_folder(spark, "archive"), work_folder(spark, "history")
    records = _with_iso_time(chat_view(spark, folder, message=F.length("message").cast("string")))
    early = F.coalesce(F.col("user").rlike("[0-4]$"), F.lit(False))
    runs = []
    for run, added in enumerate((early, ~early, None)):
        if added is not None:
            archive.write_archive(records.filter(added), source)
        conversion = archive.start_conversion(spark, source, history, f"{history}-checkpoint")
        finish(conversion)
        read = sum(progress.numInputRows for progress in conversion.recentProgress)
        # Read now: the history grows.
        runs.append((run, read, archive.read_history(spark, history).count()))
    return spark.createDataFrame(runs, "run int, n_read bigint, n_history bigint")


@_query
def archive_if_absent(spark, folder):
    """The history after runs that convert only what is absent: none yet, a whole one, one without its marker."""
    source, history = work_folder(spark, "archive"), work_folder(spark, "history")
    unfinished = work_folder(spark, "history")
    records = _with_iso_time(chat_view(spark, folder, message=F.length("message").cast("string")))
    early = F.coalesce(F.col("user").rlike("[0-4]$"), F.lit(False))
    runs = []
    for run, (added, target) in enumerate(((early, history), (~early, history), (None, unfinished))):
        if added is not None:
            archive.write_archive(records.filter(added), source)
        else:
            # What a run leaves that died on its way.
            some = records.filter(early).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            some.parquet(unfinished)
        archive.convert_archive(spark, source, target, only_if_absent=True)
        # Read now: the archive grows.
        seen = archive.read_history(spark, target).agg(F.count("*"), F.count("user"), F.count("timestamp")).first()
        runs.append((run, *seen))
    return spark.createDataFrame(runs, "run int, n_history bigint, n_users bigint, n_timed bigint")


# --- tables -------------------------------------------------------------------


@_query
def declared_tables(spark, folder):
    """Users and windows in tables declared by name, replaced once, and read by name."""
    location = work_folder(spark, "declared")
    database = "chat_" + location.rsplit("-", 1)[1]
    users = _users(spark, folder)
    windows = activity.window_activity(posts(spark, folder).filter("timestamp IS NOT NULL"))
    parts = []
    for table, rows in ((schemas.USER_ACTIVITY, users), (schemas.WINDOW_ACTIVITY, windows)):
        for content in (rows.limit(0), rows):
            declared.declare(spark, database, table, location)
            declared.replace(spark, database, table, content)
        stored = declared.read(spark, database, table)
        parts.append(
            stored.select(
                F.lit(table.name).alias("table_name"),
                F.date_format(table.key.name, "yyyy-MM-dd HH:mm:ss").alias("key")
                if table is schemas.WINDOW_ACTIVITY else F.col(table.key.name).alias("key"),
                F.col(table.values[0].name).alias("n"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@_query
def upsert_latest(spark, folder):
    """Counts, then a second write that replaces the rows of the busier users."""
    table = KeyedTable(work_folder(spark, "table"), schemas.USER_ACTIVITY)
    table.put(_users(spark, folder), generation=1, epoch=0)
    first = table.latest(spark)
    busier = first.filter(F.col("nb_messages") > 66)
    table.put(busier.withColumn("nb_messages", F.col("nb_messages") * 10), generation=1, epoch=1)
    return table.latest(spark)


@_query
def user_counts_int(spark, folder):
    """The counts as a store with 32-bit columns gets them."""
    counts = activity.user_counts(_flagged(spark, folder))
    return schemas.USER_COUNTS.narrowed().conform(counts)


@_query
def batch_rerun_empty(spark, folder):
    """Statistics of a full run, and of a run after it over an empty archive."""
    history, tables = work_folder(spark, "history"), work_folder(spark, "tables")
    nothing = work_folder(spark, "archive")
    archive.write_archive(_with_iso_time(chat_view(spark, folder)).limit(0), nothing)
    shown = []
    for run, source in enumerate((_archive(spark, folder), nothing)):
        batch_layer.run_batch(spark, source, history, tables)
        totals = batch_layer.result_table(tables, schemas.GLOBAL_STATS).newest_epoch(spark, batch_layer.GENERATION)
        users = batch_layer.current_users(spark, tables)
        users = users.agg(F.lit("users").alias("metric_name"), F.count("*").cast("double").alias("value"))
        shown.append(totals.unionByName(users).withColumn("run", F.lit(run)))
    return reduce(DataFrame.unionByName, shown)


@_query
def batch_job(spark, folder):
    """All result tables of a batch run, one under the other."""
    history, tables = work_folder(spark, "history"), work_folder(spark, "tables")
    batch_layer.run_batch(spark, _archive(spark, folder), history, tables)
    users = batch_layer.current_users(spark, tables)
    ranking = batch_layer.current_words(spark, tables)
    totals = batch_layer.result_table(tables, schemas.GLOBAL_STATS).latest(spark)
    parts = [
        df.select(
            F.lit(table.name).alias("table_name"),
            F.col(df.columns[0]).alias("key"),
            F.col(df.columns[1]).cast("double").alias("value"),
        )
        for table, df in (
            (schemas.TOP_USERS, users),
            (schemas.TOP_WORDS, ranking),
            (schemas.GLOBAL_STATS, totals),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def batch_preview(spark, folder):
    """What a batch run shows of its results."""
    history, tables = work_folder(spark, "history"), work_folder(spark, "tables")
    batch_layer.run_batch(spark, _archive(spark, folder), history, tables)
    parts = [
        rows.select(F.lit(name).alias("shown"), F.col(rows.columns[0]).alias("key"), F.col(rows.columns[1]).cast("double").alias("value"))
        for name, rows in batch_layer.previews(spark, tables).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def metric_log(spark, folder):
    """Long-format metrics of two runs; the archive grows between them."""
    history, tables = work_folder(spark, "history"), work_folder(spark, "tables")
    source = work_folder(spark, "archive")
    records = _with_iso_time(chat_view(spark, folder))
    early = F.coalesce(F.col("user").rlike("[0-4]$"), F.lit(False))
    for run, at, added in ((1, "2024-02-01 00:00:00", early), (2, "2024-02-02 00:00:00", ~early)):
        archive.write_archive(records.filter(added), source)
        batch_layer.run_metric_log(spark, source, history, tables, run, at)
    return _with_naive(read_metrics(spark, f"{tables}/stats"), "timestamp")


# --- streams ------------------------------------------------------------------


def _topic(spark: SparkSession, folder: str) -> DataFrame:
    """The chat, published to a topic with its event time and opened as a stream."""

    def write(path: str) -> None:
        timed = _with_iso_time(chat_view(spark, folder))
        payloads = ingest.encode_payload(timed, *schemas.CHAT.names)
        topics.publish(payloads, topics.file_target(path))

    return topics.read_files(spark, _derived(spark, folder, "topic", write))


TOPIC_PARTS = 6
#: Files of a part, so that its tasks share it; a trigger reads as many.
PART_FILES = 4


def _topic_in_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The chat in several files that each span all of its time, one a trigger."""

    def write(path: str) -> None:
        part = F.unix_timestamp("timestamp") % TOPIC_PARTS
        messages = chat_view(spark, folder, sort_texts=False).filter("timestamp IS NOT NULL").withColumn("part", part)
        # Texts meet their events once and not once a part.
        joined = work_folder(spark, "joined")
        messages.write.parquet(joined)
        messages = spark.read.schema(messages.schema).parquet(joined)
        # In turn, as repartition() without a key would, which sorts whole messages before.
        number_of_file = (F.monotonically_increasing_id() + F.spark_partition_id()) % PART_FILES
        for number in range(TOPIC_PARTS):
            dealt = messages.filter(F.col("part") == number).withColumn("file", number_of_file)
            timed = _with_iso_time(dealt.repartitionById(PART_FILES, F.col("file").cast("int")))
            payloads = ingest.encode_payload(timed, *schemas.CHAT.names)
            topics.publish(payloads, topics.file_target(path))
        remove(spark, joined)

    path = _derived(spark, folder, "parts", write)
    return topics.read_files(spark, path, max_files_per_trigger=PART_FILES)


def derive_inputs(spark: SparkSession, folder: str) -> None:
    """Writes what the stream and archive queries start from, where it is not there yet."""
    _archive(spark, folder)
    _topic(spark, folder)
    _topic_in_parts(spark, folder)


def _flagged_stream(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.flagged_messages(_topic(spark, folder), time_source="event")


def _windows_of(payloads: DataFrame, watermark: str = metrics.WATERMARK) -> DataFrame:
    spark = payloads.sparkSession
    tables = work_folder(spark, "tables")
    flagged = metrics.flagged_messages(payloads, time_source="event")
    finish(
        speed_layer.start_window_table(
            flagged, tables, f"{tables}-checkpoint", watermark=watermark, available_now=True
        )
    )
    return speed_layer.read_windows(spark, tables, time_source="event")


def _stream_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _with_naive(_windows_of(_topic(spark, folder)), "window_start")


@_query
def stream_windows_in_triggers(spark, folder):
    """Windows over several triggers out of time order, with a watermark as wide as that needs."""
    counts = _windows_of(_topic_in_parts(spark, folder), watermark="36500 days")
    return _with_naive(counts, "window_start")


@_query
def stream_late_rows(spark, folder):
    """How many messages the narrow watermark drops over the same triggers."""
    counts = _windows_of(_topic_in_parts(spark, folder))
    everything = stats.total_messages(posts(spark, folder).filter("timestamp IS NOT NULL"))
    counted = counts.agg(F.sum("total_messages").alias("n_counted"))
    # One row each.
    both = everything.crossJoin(F.broadcast(counted))
    return both.select("n_counted", (F.col("total_messages") - F.col("n_counted")).alias("n_late"))


@_query
def stream_late_messages(spark, folder):
    """Late messages themselves, and the counts of the windows: together, all that was published."""
    path = work_folder(spark, "split")
    flagged = metrics.flagged_messages(_topic_in_parts(spark, folder), time_source="event")
    finish(late.start_split(flagged, path, f"{path}-checkpoint", available_now=True))
    came_late = late.read_late(spark, path).select(
        F.lit("late").alias("state"), "user", _naive("timestamp"), F.lit(1).cast("bigint").alias("n"),
        F.coalesce("is_toxic", F.lit(False)).cast("bigint").alias("n_toxic"),
    )
    counted = late.read_counted(spark, path).select(
        F.lit("counted").alias("state"), F.lit(None).cast("string").alias("user"),
        _naive("window_start").alias("timestamp"), F.col("total_messages").alias("n"),
        F.col("total_toxic_messages").alias("n_toxic"),
    )
    return came_late.unionByName(counted)


@_query
def stream_restart(spark, folder):
    """Counts per user of a query that was stopped, went on, and found its topic grown."""
    topic, tables = work_folder(spark, "topic"), work_folder(spark, "tables")
    messages = _with_iso_time(chat_view(spark, folder))
    early = F.coalesce(F.col("user").rlike("[0-4]$"), F.lit(False))

    def publish(rows: DataFrame) -> None:
        payloads = ingest.encode_payload(rows, *schemas.CHAT.names)
        topics.publish(payloads.repartition(PART_FILES), topics.file_target(topic))

    def start_again(**trigger):
        payloads = topics.read_files(spark, topic, max_files_per_trigger=1)
        flagged = metrics.flagged_messages(payloads, time_source="event")
        return speed_layer.start_user_table(flagged, tables, f"{tables}-checkpoint", **trigger)

    publish(messages.filter(early))
    stopped = start_again(every="0 seconds")
    try:
        # One trigger is through, or two, and others may be at work.
        while stopped.isActive and not stopped.recentProgress:
            stopped.awaitTermination(1)
    finally:
        stopped.stop()
    if stopped.exception() is not None:
        raise stopped.exception()
    finish(start_again(available_now=True))
    publish(messages.filter(~early))
    finish(start_again(available_now=True))
    return speed_layer.read_user_counts(spark, tables)


@_query
def stream_state_rows(spark, folder):
    """The windows that a stream still holds once all is read and the watermark has moved."""
    tables = work_folder(spark, "tables")
    flagged = metrics.flagged_messages(_topic_in_parts(spark, folder), time_source="event")
    finish(
        speed_layer.start_window_table(flagged, tables, f"{tables}-checkpoint", watermark="10 days", available_now=True)
    )
    held = speed_layer.state_rows(spark, f"{tables}-checkpoint").drop("window_end")
    return _with_naive(held, "window_start")


@_query
def stream_complete_ranking(spark, folder):
    """All users by messages, as the last of several triggers wrote them in complete mode."""
    tables = work_folder(spark, "tables")
    flagged = metrics.flagged_messages(_topic_in_parts(spark, folder), time_source="event")
    finish(speed_layer.start_ranking_table(flagged, tables, f"{tables}-checkpoint", available_now=True))
    return speed_layer.read_ranking_table(spark, tables)


@_query
def stream_processing_time(spark, folder):
    """Windows of the triggers' own time: all messages, none late, in no more windows than triggers."""
    tables = work_folder(spark, "tables")
    flagged = metrics.flagged_messages(_topic_in_parts(spark, folder), time_source="processing")
    query = speed_layer.start_window_table(flagged, tables, f"{tables}-checkpoint", every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    windows = speed_layer.read_windows(spark, tables, time_source="processing")
    return windows.agg(
        F.sum("total_messages").alias("total_messages"),
        F.sum("total_toxic_messages").alias("total_toxic_messages"),
        (F.count("*") <= TOPIC_PARTS).alias("is_one_time_a_trigger"),
        F.bool_and(F.unix_timestamp("window_start") % 10 == 0).alias("is_aligned"),
    ).withColumn("n_late", F.lit(late_rows(query)).cast("bigint"))


@_query
def stream_supervised(spark, folder):
    """The tables of the queries that run side by side, as fast as they can, until one of them is stopped."""
    tables = work_folder(spark, "tables")
    queries = speed_layer.start_tables(_topic(spark, folder), tables, f"{tables}-checkpoint", time_source="event")

    def stop_once_read() -> None:
        try:
            for query in queries:
                query.processAllAvailable()
        finally:
            # The others are stopped by what supervises them, which raises if one failed.
            queries[0].stop()

    with ThreadPoolExecutor(1) as aside:
        stopped = aside.submit(stop_once_read)
        supervise(spark, queries)
    stopped.result()
    windows = _with_naive(speed_layer.read_windows(spark, tables, time_source="event"), "window_start")
    users = speed_layer.read_user_counts(spark, tables)
    untimed = spark.read.schema(schemas.CHAT).json(speed_layer.untimed_folder(tables))
    return reduce(
        DataFrame.unionByName,
        (
            windows.select(
                F.lit("windows").alias("table_name"), F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("key"),
                F.col("total_messages").alias("n"), F.col("total_toxic_messages").alias("n_toxic"),
            ),
            users.select(
                F.lit("users").alias("table_name"), F.col("user").alias("key"),
                F.col("nb_messages").alias("n"), F.col("nb_toxic_messages").alias("n_toxic"),
            ),
            untimed.agg(
                F.lit("untimed").alias("table_name"), F.lit(None).cast("string").alias("key"),
                F.count("*").alias("n"), F.lit(None).cast("bigint").alias("n_toxic"),
            ),
        ),
    )


@_query
def stream_messages_per_minute(spark, folder):
    tables = work_folder(spark, "tables")
    messages = metrics.stamp(ingest.decode_payload(_topic(spark, folder)), "event")
    finish(
        speed_layer.start_minute_table(
            messages, tables, f"{tables}-checkpoint", available_now=True
        )
    )
    minutes = speed_layer.read_windows(spark, tables, schemas.MINUTE_ACTIVITY, "event")
    return _with_naive(minutes, "window_start")


def _stream_user_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = work_folder(spark, "tables")
    flagged = _flagged_stream(spark, folder)
    finish(
        speed_layer.start_user_table(
            flagged, tables, f"{tables}-checkpoint", available_now=True
        )
    )
    return speed_layer.read_user_counts(spark, tables)


@_query
def stream_global_activity(spark, folder):
    return activity.total_part(_stream_window_counts(spark, folder))


@_query
def stream_toxic_activity(spark, folder):
    return activity.toxic_part(_stream_window_counts(spark, folder))


@_query
def stream_user_activity(spark, folder):
    return activity.total_part(_stream_user_counts(spark, folder))


@_query
def stream_toxic_users(spark, folder):
    return activity.toxic_part(_stream_user_counts(spark, folder))


def _stream_ranking(spark: SparkSession, folder: str, table: schemas.ResultTable) -> DataFrame:
    tables = work_folder(spark, "tables")
    flagged = _flagged_stream(spark, folder)
    finish(
        speed_layer.start_user_table(
            flagged, tables, f"{tables}-checkpoint", available_now=True
        )
    )
    return speed_layer.read_ranking(spark, tables, table)


@_query
def stream_user_ranking(spark, folder):
    return _stream_ranking(spark, folder, schemas.USER_ACTIVITY)


@_query
def stream_toxic_user_ranking(spark, folder):
    return _stream_ranking(spark, folder, schemas.TOXIC_USERS)


@_query
def stream_archive(spark, folder):
    path = work_folder(spark, "archive")
    finish(
        metrics.start_archive(
            _topic(spark, folder), path, f"{path}-checkpoint", available_now=True
        )
    )
    return archive.read_archive(spark, path).drop("timestamp")


@_query
def archive_quarantine(spark, folder):
    """Payloads by the output that has them: the archive, or beside it what is no message."""
    topic, path = work_folder(spark, "topic"), work_folder(spark, "archive")
    topics.publish(_partly_broken(spark, folder), topics.file_target(topic))
    finish(*speed_layer.start_archives(topics.read_files(spark, topic), path, f"{path}-checkpoint", available_now=True))
    outputs = {
        False: archive.read_archive(spark, path),
        True: spark.read.schema(topics.VALUE).parquet(f"{path}-rejected"),
    }
    counted = (rows.agg(F.lit(state).alias("is_rejected"), F.count("*").alias("n")) for state, rows in outputs.items())
    return reduce(DataFrame.unionByName, counted)
