"""The metric streams over file topics: equal to batch, late rows, restarts, failures."""

import random
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from chatpulse import schemas
from chatpulse.operators import activity
from chatpulse.operators.ingest import decode_payload
from chatpulse.plans import batch_layer, catalog, speed_layer
from chatpulse.settings import configured
from chatpulse.sinks import connectors
from chatpulse.sinks.connectors import connector_writer
from chatpulse.sources import archive, topics
from chatpulse.sources.chat import chat_view
from chatpulse.streaming import late, metrics
from chatpulse.streaming.run import finish, late_rows, supervise
from chatpulse.streaming.watch import StalledQuery, Watch
from helpers import add_file, at, chat, counted, rows


class Topic:
    """A file topic, its result tables and its checkpoints."""

    def __init__(self, spark, folder):
        self.spark, self.root = spark, folder
        self.path = f"{folder}/topic"
        self.tables = f"{folder}/tables"

    def add(self, *messages):
        add_file(self.spark, self.path, *messages)

    def stream(self):
        return topics.read_files(self.spark, self.path, max_files_per_trigger=1)

    def run(self, checkpoints="c", time_source="event", **more):
        queries = speed_layer.start_tables(
            self.stream(), self.tables, f"{self.root}/{checkpoints}",
            time_source=time_source, available_now=True, **more,
        )
        finish(*queries)
        return queries

    def windows(self, time_source="event"):
        return counted(speed_layer.read_windows(self.spark, self.tables, time_source=time_source))

    def users(self):
        return counted(speed_layer.read_user_counts(self.spark, self.tables))


@pytest.fixture
def topic(spark, folder):
    return Topic(spark, folder)


def random_messages(seed, n):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["hot", "hot", "hot", "a", "b", None]),
            rng.choice(["you idiot", "hello", None, "TRASH talk", "trashy"]),
            second,
        )
        for second in sorted(rng.randrange(200) for _ in range(n))
    ]


def test_streams_equal_batch_over_files_in_time_order(spark, topic):
    messages = random_messages(1, 120)
    for start in range(0, 120, 40):
        topic.add(*messages[start : start + 40])
    topic.run()
    flagged = activity.flag_toxic(chat(spark, *messages))
    assert topic.windows() == counted(activity.window_counts(flagged))
    assert topic.users() == counted(activity.user_counts(flagged))


def test_late_rows_are_dropped_one_batch_after_the_watermark(spark, topic):
    topic.add(("a", "x", 60), ("a", "x", 5))
    topic.add(("a", "x", 61))
    topic.add(("a", "x", 1), ("a", "x", 52), ("a", "x", 45))
    windows, *_ = topic.run()
    table = speed_layer.keyed(topic.tables, schemas.WINDOW_COUNTS)
    by_epoch = {
        epoch: counted(
            table.log(spark).filter(F.col("epoch") == epoch).select("window_start", "total_messages")
        )
        for epoch in (0, 1, 2)
    }
    assert by_epoch == {0: {at(0): 1, at(60): 1}, 1: {at(60): 2}, 2: {at(50): 1}}
    dropped = [s.numRowsDroppedByWatermark for p in windows.recentProgress for s in p.stateOperators]
    assert sum(dropped) == late_rows(windows) == 2
    assert topic.users() == {"a": (6, 0)}


def test_finished_windows_leave_the_state(topic):
    topic.add(("a", "clean", 5))
    topic.add(("a", "clean", 60))
    topic.add(("a", "clean", 61))
    windows, users, _ = topic.run()
    kept = [s.numRowsTotal for p in windows.recentProgress for s in p.stateOperators]
    assert kept[-1] == 1 and max(kept) == 2
    assert users.recentProgress[-1].stateOperators[0].numRowsTotal == 1


def test_restart_goes_on_from_the_checkpoint(topic):
    topic.add(("a", "idiot", 5), ("b", "x", 6))
    topic.run()
    topic.run()
    assert topic.users() == {"a": (1, 1), "b": (1, 0)}
    topic.add(("a", "x", 7))
    topic.run()
    assert topic.users() == {"a": (2, 1), "b": (1, 0)}
    assert topic.windows() == {at(0): (3, 1)}


def test_replayed_epoch_changes_nothing(spark, topic):
    topic.add(("a", "idiot", 5), ("b", "x", 6))
    topic.run()
    before = topic.users()
    table = speed_layer.keyed(topic.tables, schemas.USER_COUNTS)
    replay = spark.createDataFrame(
        [(u, *c) for u, c in before.items()], schemas.USER_COUNTS.schema
    )
    table.put(replay, 1, 0)
    assert topic.users() == before


def test_lost_checkpoint_starts_a_generation_that_wins(topic):
    topic.add(("a", "x", 5))
    topic.add(("a", "x", 6))
    topic.run("first")
    topic.run("second")
    assert topic.users() == {"a": (2, 0)}
    assert topic.windows() == topic.windows("processing") == {at(0): (2, 0)}


def test_windows_of_event_time_outlive_the_topic(topic):
    topic.add(("a", "x", 5), ("a", "x", 6))
    topic.add(("a", "idiot", 65))
    topic.run("first")
    for part in Path(topic.path).glob("part-*"):
        part.unlink()
    topic.add(("a", "idiot", 66), ("b", "x", 130))
    topic.run("second")
    assert topic.windows() == {at(0): (2, 0), at(60): (1, 1), at(130): (1, 0)}
    assert topic.windows("processing") == {at(60): (1, 1), at(130): (1, 0)}


def test_a_wider_watermark_counts_rows_out_of_order(spark, topic):
    messages = random_messages(3, 90)
    for part in range(3):
        topic.add(*messages[part::3])
    windows, *_ = topic.run(watermark="10 minutes", window="20 seconds")
    flagged = activity.flag_toxic(chat(spark, *messages))
    assert topic.windows() == counted(activity.window_counts(flagged, "20 seconds"))
    assert late_rows(windows) == 0


def test_messages_without_a_time_are_kept_beside_the_windows(spark, topic):
    topic.add(("a", "x", 5), ("b", "idiot", None), ("b", "y", None))
    topic.run()
    assert topic.windows() == {at(0): (1, 0)} and topic.users() == {"a": (1, 0), "b": (2, 1)}
    untimed = archive.read_archive(spark, speed_layer.untimed_folder(topic.tables))
    assert rows(untimed.select("user", "message")) == [("b", "idiot"), ("b", "y")]


def test_processing_time_gives_a_trigger_one_window(spark, topic):
    topic.add(("a", "idiot", 5), ("b", "x", 500), (None, None, None))
    topic.run(time_source="processing")
    (only,) = topic.windows("processing").values()
    assert only == (3, 1)


def test_malformed_payloads_count_for_windows_in_processing_time(spark, folder):
    spark.createDataFrame(
        [(bytearray(b"not json"),), (bytearray(b'{"user":"a","message":"hate"}'),)], "value binary"
    ).coalesce(1).write.parquet(f"{folder}/topic")
    topic = Topic(spark, folder)
    topic.run(time_source="processing")
    assert list(topic.windows("processing").values()) == [(2, 1)]
    assert topic.users() == {"a": (1, 1)}


def test_unknown_time_source_is_refused(spark):
    with pytest.raises(ValueError):
        metrics.stamp(chat(spark, ("a", "x", 1)), "arrival")


def test_rankings_are_whole_and_sorted(spark, topic):
    topic.add(("a", "hate", 1), ("b", "x", 2), ("b", "x", 3))
    topic.add(("c", "x", 4), ("a", "noob", 5), ("a", "x", 6))
    topic.run()
    # A trigger writes the users it changed and no others.
    assert speed_layer.keyed(topic.tables, schemas.USER_COUNTS).log(spark).count() == 4
    for table, expected in (
        (schemas.USER_ACTIVITY, [("a", 3), ("b", 2), ("c", 1)]),
        (schemas.TOXIC_USERS, [("a", 2)]),
    ):
        ranking = speed_layer.read_ranking(spark, topic.tables, table)
        assert [tuple(r) for r in ranking.collect()] == expected


def test_archive_stream_keeps_good_payloads_once(spark, folder, topic):
    topic.add(("a", "x\ny", 1), ("b", None, 2))
    spark.createDataFrame([(bytearray(b"{broken"),)], "value binary").write.mode(
        "append"
    ).parquet(topic.path)
    for _ in range(2):
        finish(*speed_layer.start_archives(topic.stream(), f"{folder}/archive", f"{folder}/c", available_now=True))
    rejected = spark.read.schema(topics.VALUE).parquet(f"{folder}/archive-rejected")
    assert [bytes(r.value) for r in rejected.collect()] == [b"{broken"]
    records = archive.read_archive(spark, f"{folder}/archive")
    assert rows(records.select("user", "message")) == [("a", "x\ny"), ("b", None)]
    assert records.filter("try_to_timestamp(timestamp) IS NULL").count() == 0


def test_stream_to_batch_agree(spark, folder, topic):
    """The archive a stream wrote feeds the batch job, which counts the same users."""
    topic.add(*[(u, m, s) for u, m, s in random_messages(2, 60) if u])
    topic.run()
    finish(
        metrics.start_archive(
            topic.stream(), f"{folder}/archive", f"{folder}/ca", available_now=True
        )
    )
    batch_layer.run_batch(spark, f"{folder}/archive", f"{folder}/history", f"{folder}/batch")
    users = batch_layer.result_table(f"{folder}/batch", schemas.TOP_USERS).latest(spark)
    assert counted(users) == {u: n for u, (n, _) in topic.users().items()}


def test_outside_store_gets_four_tables(spark, folder, topic, monkeypatch):
    topic.add(("a", "hate", 1), ("b", "x", 12), (None, "x", 13))
    monkeypatch.setattr(
        connectors, "cassandra_options", lambda keyspace, table: {"path": f"{folder}/{keyspace}/{table}"}
    )
    finish(
        *speed_layer.start_cassandra(
            topic.stream(), "store", f"{folder}/c", time_source="event",
            form="parquet", names={"window_activity": "live_windows"}, available_now=True,
        )
    )
    def table(name):
        return spark.read.parquet(f"{folder}/store/{name}")

    assert counted(table("live_windows")) == {at(0): 1, at(10): 2}
    assert counted(table("toxic_window_activity")) == {at(0): 1}
    assert counted(table("user_activity")) == {"a": 1, "b": 1}
    assert counted(table("toxic_users")) == {"a": 1}
    assert dict(table("toxic_users").dtypes)["nb_toxic_messages"] == "int"


def test_consoles_show_every_metric(folder, topic):
    topic.add(("ann", "hate", 1), ("bob", "x", 12))
    queries = speed_layer.start_consoles(
        topic.stream(), f"{folder}/c", time_source="event", available_now=True
    )
    finish(*queries)
    assert all("Console" in q.lastProgress.sink.description for q in queries)
    shown = [q.recentProgress[0].sink.numOutputRows for q in queries]
    assert shown == [2, 2, 1]


def test_finish_stops_the_rest_and_raises(spark, folder, topic):
    topic.add(("a", "x", 1))

    def fail(batch, epoch):
        raise RuntimeError("sink is gone")

    flagged = metrics.flagged_messages(topic.stream())
    bad = metrics.start_to(metrics.window_counts(flagged), fail, f"{folder}/bad", available_now=True)
    good = metrics.start_to(
        metrics.user_counts(flagged), connector_writer("noop", {}, schemas.USER_COUNTS), f"{folder}/good", every="1 second"
    )
    with pytest.raises(StreamingQueryException):
        finish(bad, good)
    assert not good.isActive and not bad.isActive


def test_default_trigger_runs_until_it_is_stopped(folder, topic):
    topic.add(("a", "x", 1))
    flagged = metrics.flagged_messages(topic.stream())
    query = metrics.start_to(
        metrics.user_counts(flagged), connector_writer("noop", {}, schemas.USER_COUNTS), f"{folder}/c"
    )
    query.processAllAvailable()
    assert query.isActive and query.lastProgress is not None
    query.stop()


def test_supervise_stops_the_rest_and_raises(spark, folder, topic):
    topic.add(("a", "x", 1))

    def fail(batch, epoch):
        raise RuntimeError("sink is gone")

    flagged = metrics.flagged_messages(topic.stream())
    good = metrics.start_to(
        metrics.user_counts(flagged),
        connector_writer("noop", {}, schemas.USER_COUNTS),
        f"{folder}/good", every="1 second",
    )
    bad = metrics.start_to(
        metrics.window_counts(flagged), fail, f"{folder}/bad", every="1 second"
    )
    with pytest.raises(StreamingQueryException):
        supervise(spark, [good, bad])
    assert not good.isActive and not bad.isActive
    assert spark.streams.active == []


def test_jobs_run_from_the_command_line(spark, folder, topic):
    topic.add(("a", "hate", 1), ("b", "naughty", 2))
    common = ["--topic-folder", topic.path, "--checkpoints", f"{folder}/c", "--available-now"]
    speed_layer.main(
        ["tables", *common, "--tables", topic.tables, "--time-source", "event", "--words", "naughty,rude"]
    )
    assert topic.users() == {"a": (1, 0), "b": (1, 1)}
    speed_layer.main(["archive", *common, "--archive", f"{folder}/archive", "--show-rate"])
    batch_layer.main(
        ["--archive", f"{folder}/archive", "--history", f"{folder}/h", "--tables", f"{folder}/t"]
    )
    users = batch_layer.result_table(f"{folder}/t", schemas.TOP_USERS).latest(spark)
    assert counted(users) == {"a": 1, "b": 1}
    with pytest.raises(SystemExit):
        speed_layer.main(["tables", "--checkpoints", "c", "--tables", "t"])
    with pytest.raises(SystemExit):
        speed_layer.main(["archive", *common])
    with pytest.raises(SystemExit):
        speed_layer.main(["tables", *common, "--tables", "t", "--table-names", "a=b"])


def test_late_rows_are_told_from_the_command_line(folder, topic, capsys):
    topic.add(("a", "x", 500))
    topic.add(("a", "x", 501))
    topic.add(("a", "x", 1))
    common = ["--topic-folder", topic.path, "--available-now", "--time-source", "event", "--max-files-per-trigger", "1"]
    speed_layer.main(["tables", *common, "--checkpoints", f"{folder}/c1", "--tables", f"{folder}/t1"])
    assert "1 rows came after the watermark" in capsys.readouterr().out
    speed_layer.main(
        ["tables", *common, "--checkpoints", f"{folder}/c2", "--tables", f"{folder}/t2", "--watermark", "1 hour"]
    )
    assert "watermark" not in capsys.readouterr().out


def test_late_messages_are_kept_and_the_rest_counted_as_the_state_counts_them(spark, topic):
    """Triggers out of time order: windows as of the stateful query, and every late message as a row."""
    rng = random.Random(4)
    messages = [(rng.choice("abc"), rng.choice(["x", "idiot", None]), rng.randrange(300)) for _ in range(240)]
    messages += [("a", "same", 5)] * 4 + [("b", "never", None)]
    rng.shuffle(messages)
    for start in range(0, len(messages), 35):
        topic.add(*messages[start : start + 35])
    topic.run()
    path = f"{topic.root}/split"
    flagged = metrics.flagged_messages(topic.stream(), time_source="event")
    finish(late.start_split(flagged, path, f"{path}-c", available_now=True))
    counts = late.read_counted(spark, path)
    assert counted(counts) == topic.windows()
    came_late = late.read_late(spark, path)
    total = counts.agg(F.sum("total_messages")).first()[0]
    assert came_late.count() > 20
    assert total + came_late.count() == len(messages) - 1
    # The counted and the late together are all that was published.
    every = counted(activity.window_counts(activity.flag_toxic(chat(spark, *messages).filter("timestamp IS NOT NULL"))))
    again = counted(
        activity.window_counts(came_late).unionByName(counts)
        .groupBy("window_start").agg(F.sum("total_messages"), F.sum("total_toxic_messages"))
    )
    assert again == every


def test_a_split_trigger_that_runs_again_replaces_what_it_wrote(spark, topic):
    topic.add(("a", "x", 60))
    topic.add(("a", "x", 90))
    topic.add(("a", "late", 5), ("b", "x", 95))
    path = f"{topic.root}/split"

    def run():
        flagged = metrics.flagged_messages(topic.stream(), time_source="event")
        finish(late.start_split(flagged, path, f"{path}-c", available_now=True))

    run()
    before = counted(late.read_counted(spark, path)), rows(late.read_late(spark, path).drop("timestamp"))
    assert before[1] == [("a", "late", False, 2)]
    for commit in Path(f"{path}-c/commits").glob("*2*"):
        commit.unlink()
    run()
    assert (counted(late.read_counted(spark, path)), rows(late.read_late(spark, path).drop("timestamp"))) == before


def test_state_rows_are_the_windows_that_are_held(spark, topic):
    topic.add(("a", "idiot", 5), ("a", "x", 6))
    topic.add(("a", "x", 60), ("b", "x", 61))
    topic.add(("a", "x", 75))
    topic.run()
    held = speed_layer.state_rows(spark, f"{topic.root}/c")
    assert held.columns == ["window_start", "window_end", "total_messages", "total_toxic_messages"]
    assert counted(held.drop("window_end")) == {at(60): (2, 0), at(70): (1, 0)}
    assert counted(held.select("window_start", F.col("window_end").cast("string"))) == {at(60): at(70), at(70): at(80)}


def test_complete_mode_keeps_the_last_trigger_s_ranking(spark, topic):
    topic.add(("a", "idiot", 5), ("a", "x", 6), ("b", "x", 7))
    topic.add(("b", "idiot", 8), ("b", "noob", 9), ("c", "x", 1))
    flagged = metrics.flagged_messages(topic.stream(), time_source="event")
    for ranked in (schemas.USER_ACTIVITY, schemas.TOXIC_USERS):
        finish(speed_layer.start_ranking_table(flagged, topic.tables, f"{topic.root}/r", ranked, available_now=True))
    shown = [tuple(r) for r in speed_layer.read_ranking_table(spark, topic.tables).collect()]
    assert shown == [("b", 3), ("a", 2), ("c", 1)]
    toxic = speed_layer.read_ranking_table(spark, topic.tables, schemas.TOXIC_USERS).collect()
    assert [tuple(r) for r in toxic] == [("b", 2), ("a", 1)]
    stored = speed_layer.keyed(f"{topic.tables}/ranking", schemas.USER_ACTIVITY)
    # Every trigger wrote all users it knew of; their order is that of reading.
    written = [rows(stored.at(spark, 1, epoch)) for epoch in (0, 1)]
    assert written == [[("a", 2), ("b", 1)], sorted(shown)]


def test_conversion_reads_new_archive_files_only(spark, folder):
    source, history = f"{folder}/archive", f"{folder}/history"

    def add(*messages, extra=()):
        frame = chat(spark, *messages)
        archive.write_archive(frame.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")), source)
        if extra:
            spark.createDataFrame([(x,) for x in extra], "value string").write.mode("append").text(source)

    def convert():
        query = archive.start_conversion(spark, source, history, f"{folder}/c")
        finish(query)
        return sum(p.numInputRows for p in query.recentProgress)

    add(("a", "x", 1), ("b", None, 2), extra=["no json", " "])
    assert convert() == 4
    add(("c", "y", 3))
    assert convert() == 1
    assert convert() == 0
    assert sorted(r.user for r in archive.read_history(spark, history).collect()) == ["a", "b", "c"]
    assert rows(archive.read_rejected(spark, history)) == [("no json",)]
    # As the conversion of all of it at once.
    archive.convert_archive(spark, source, f"{folder}/whole")
    assert rows(archive.read_history(spark, history)) == rows(archive.read_history(spark, f"{folder}/whole"))


def test_watch_tells_progress_silence_and_failure(spark, topic):
    topic.add(("a", "idiot", 60), ("a", "x", 61))
    topic.add(("b", "x", 62))
    now = [0.0]
    with Watch(clock=lambda: now[0]).attach(spark) as watch:
        good = metrics.start_console(
            metrics.window_counts(metrics.flagged_messages(topic.stream(), time_source="event")),
            f"{topic.root}/good", available_now=True,
        )
        finish(good)

        def fails(batch, epoch):
            raise RuntimeError("no space left")

        bad = metrics.start_to(topic.stream(), fails, f"{topic.root}/bad", "append", available_now=True)
        with pytest.raises(StreamingQueryException):
            finish(bad)
        wait = threading.Event()
        held = metrics.start_to(topic.stream(), lambda batch, epoch: wait.wait(60), f"{topic.root}/held", "append", available_now=True)
        try:
            until(lambda: str(held.runId) in watch.seen() and len(watch.failures()) == 1)
            seen = watch.seen()[str(good.runId)]
            until(lambda: watch.seen()[str(good.runId)].is_over)
            assert (seen.rows, seen.triggers >= 2, seen.failure) == (3, True, None)
            assert "no space left" in watch.failures()[0].failure
            assert watch.stalled(5) == {}
            now[0] = 10.0
            assert set(watch.stalled(5)) == {str(held.runId)}
        finally:
            wait.set()
            held.stop()
        assert watch.report().count("\n") == 2


def until(holds, seconds=30):
    end = time.monotonic() + seconds
    while not holds():
        assert time.monotonic() < end
        time.sleep(0.05)


def test_supervise_ends_a_job_of_which_a_query_hangs(spark, topic):
    topic.add(("a", "x", 1))
    wait = threading.Event()
    held = metrics.start_to(topic.stream(), lambda batch, epoch: wait.wait(60), f"{topic.root}/held", "append")
    idle = metrics.start_to(topic.stream(), lambda batch, epoch: None, f"{topic.root}/idle", "append")
    try:
        with pytest.raises(StalledQuery, match=str(held.id)):
            threading.Timer(12, wait.set).start()
            supervise(spark, [held, idle], stall_seconds=4)
    finally:
        wait.set()
    assert not held.isActive and not idle.isActive


def test_parts_of_a_topic_are_published_from_messages_that_were_joined_once(spark, folder, monkeypatch):
    """Six parts of four files; publishing one neither joins the texts again nor sorts them."""
    own = configured(spark)
    data = f"{folder}/data"
    events = own.range(241).select(
        F.when(F.col("id") != 7, F.col("id")).alias("event_id"), (F.col("id") % 5).alias("user_id"),
        F.when(F.col("id") != 9, F.timestamp_seconds(1704067200 + F.col("id") * 7)).alias("ts"),
    )
    # Repeated ids on one side, as events may have; the last has no text.
    events.union(events.filter("event_id IN (3, 4)")).write.parquet(f"{data}/events.parquet")
    own.range(240).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text")
    ).write.parquet(f"{data}/documents.parquet")
    plans, publish = [], topics.publish

    def seen(payloads, target):
        plans.append(payloads._jdf.queryExecution().optimizedPlan().toString())
        publish(payloads, target)

    monkeypatch.setattr(topics, "publish", seen)
    catalog._topic_in_parts(own, data)
    assert len(plans) == catalog.TOPIC_PARTS
    assert not any("Join" in plan or "Repartition " in plan for plan in plans)
    path = catalog._DERIVED[(spark.sparkContext.applicationId, data, "parts")]
    files = sorted(Path(path.removeprefix("file:")).glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
    assert len(files) == catalog.TOPIC_PARTS * catalog.PART_FILES
    got = []
    for number in range(catalog.TOPIC_PARTS):
        some = files[number * catalog.PART_FILES : (number + 1) * catalog.PART_FILES]
        payloads = own.read.schema(topics.VALUE).parquet(*map(str, some))
        messages = decode_payload(payloads).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        assert {r[0] for r in messages.select(F.unix_timestamp("timestamp") % catalog.TOPIC_PARTS).collect()} == {number}
        got += rows(messages.select("user", "message", "timestamp"))
    view = chat_view(own, data).filter("timestamp IS NOT NULL").select("user", "message", "timestamp")
    assert sorted(got, key=repr) == rows(view)
    assert len(got) == 242 and sum(r[1] is None for r in got) == 2
