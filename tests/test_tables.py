"""Keyed tables, logs, writers and the batch job."""

from pathlib import Path

import uuid

import pytest

from chatpulse import schemas
from chatpulse.operators.ingest import iso_text
from chatpulse.plans import batch_layer
from chatpulse.sinks import connectors
from chatpulse.sinks.connectors import cassandra_options, connector_writer, split_writer
from chatpulse.sinks import declared
from chatpulse.sinks.keyed import KeyedTable
from chatpulse.sinks.logs import append_metrics, read_metrics
from chatpulse.settings import remove_work_folders, shared_root, work_folder
from chatpulse.sources import archive
from helpers import chat, counted, rows


def users(spark, **counts):
    return spark.createDataFrame(list(counts.items()), "user string, nb_messages bigint")


@pytest.fixture
def table(spark, folder):
    return KeyedTable(f"{folder}/t", schemas.USER_ACTIVITY)


def test_latest_write_of_a_key_wins(spark, table):
    table.put(users(spark, a=1, b=1), 1, 0)
    table.put(users(spark, a=5), 1, 1)
    table.put(users(spark, c=2), 1, 2)
    assert counted(table.latest(spark)) == {"a": 5, "b": 1, "c": 2}


def test_repeated_epoch_replaces_itself(spark, table):
    table.put(users(spark, a=1, b=9), 1, 0)
    table.put(users(spark, a=2), 1, 0)
    assert counted(table.latest(spark)) == {"a": 2}


def test_a_new_generation_wins_over_higher_epochs(spark, table):
    table.put(users(spark, a=100, b=1), 1, 7)
    table.put(users(spark, a=3), 2, 0)
    assert counted(table.latest(spark)) == {"a": 3, "b": 1}
    assert counted(table.latest(spark, generation=2)) == {"a": 3}


def test_generation_goes_with_the_checkpoint(spark, table, folder):
    table.create_if_absent(spark)
    assert table.generation_for(spark, f"{folder}/c1") == 1
    table.put(users(spark, a=1), 1, 0)
    assert table.generation_for(spark, f"{folder}/c1") == 1
    assert table.generation_for(spark, f"{folder}/c2") == 2


def test_created_table_is_empty_and_creating_again_keeps_rows(spark, table):
    table.create_if_absent(spark)
    assert table.latest(spark).count() == 0
    table.put(users(spark, a=1), 1, 0)
    table.create_if_absent(spark)
    assert counted(table.latest(spark)) == {"a": 1}


def test_newest_epoch(spark, table):
    table.create_if_absent(spark)
    assert table.newest_epoch(spark, 1).count() == 0
    table.put(users(spark, a=1, b=2), 1, 0)
    table.put(users(spark, a=3), 1, 1)
    assert counted(table.newest_epoch(spark, 1)) == {"a": 3}


def test_an_empty_write_is_the_newest(spark, table):
    table.put(users(spark, a=1), 1, 0)
    table.put(users(spark, a=1).limit(0), 1, 1)
    assert table.last_epoch(spark, 1) == 1
    assert table.newest_epoch(spark, 1).count() == 0
    assert counted(table.latest(spark)) == {"a": 1}


def test_a_write_that_did_not_end_does_not_count(spark, table):
    table.put(users(spark, a=1), 1, 0)
    Path(f"{table.path}/generation=1/epoch=1/_temporary").mkdir(parents=True)
    Path(f"{table.path}/generation=7").mkdir()
    assert (table.last_generation(spark), table.last_epoch(spark, 1)) == (1, 0)
    assert counted(table.latest(spark)) == {"a": 1}
    assert table.generation_for(spark, f"{table.path}-c") == 8


def test_numbers_come_from_names_and_not_from_rows(spark, table):
    for epoch in range(12):
        table.put(users(spark, a=epoch), 1, epoch)
        # Rows that no reader could read.
        for part in Path(f"{table.path}/generation=1/epoch={epoch}").glob("part-*"):
            part.write_bytes(b"no parquet")
    assert table.last_generation(spark) == 1 and table.last_epoch(spark, 1) == 11


def test_folding_keeps_the_view_and_bounds_the_folders(spark, table):
    table.put(users(spark, a=100, old=9), 1, 50)
    state = {"a": 100, "old": 9}
    for epoch in range(24):
        table.put(users(spark, **{f"u{epoch % 5}": epoch, "a": epoch}), 2, epoch)
        state |= {f"u{epoch % 5}": epoch, "a": epoch}
        opened = table.latest(spark)
        if epoch % 3 == 2:
            assert table.fold(spark) == (2, epoch - 2)
        # A view that was opened before the fold can be read after it.
        assert counted(opened) == counted(table.latest(spark)) == state
        within = {k: v for k, v in state.items() if k != "old"}
        assert counted(table.latest(spark, generation=2)) == within
        assert len(table.epochs(spark, 2)) <= 8 and len(table.folds(spark)) <= 2
    assert table.fold(spark, keep=30) is None
    # A stream may write its last epoch again.
    table.put(users(spark, a=77), 2, 23)
    assert counted(table.latest(spark))["a"] == 77
    assert table.log(spark).count() <= 30


def test_largest_over_generations(spark, table):
    table.put(users(spark, w1=10, w2=20), 1, 5)
    table.put(users(spark, w2=3, w3=4), 2, 0)
    assert counted(table.largest(spark)) == {"w1": 10, "w2": 20, "w3": 4}


def test_view_is_a_hash_aggregate(spark, table):
    table.put(users(spark, a=1), 1, 0)
    plan = table.latest(spark)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_top_words_are_those_of_the_last_whole_run(spark, folder):
    """Words that left the list are gone; a run that dies on its way leaves the list of the one before."""
    tables = f"{folder}/tables"
    assert batch_layer.current_words(spark, tables).collect() == []
    for run, text in enumerate(("a a b", "c c c")):
        batch_layer.write_results(chat(spark, ("u", text, 1)), tables, run)
        assert counted(batch_layer.current_words(spark, tables)) == [{"a": 2, "b": 1}, {"c": 3}][run]
    batch_layer.result_table(tables, schemas.TOP_WORDS).put(
        spark.createDataFrame([("d", 9)], schemas.TOP_WORDS.schema), batch_layer.GENERATION, 2
    )
    assert counted(batch_layer.current_words(spark, tables)) == {"c": 3}


@pytest.fixture
def database(spark):
    name = f"chat_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_declared_tables_are_created_once_and_read_by_name(spark, folder, database):
    for _ in range(2):
        declared.declare(spark, database, schemas.USER_ACTIVITY, folder)
        declared.replace(spark, database, schemas.USER_ACTIVITY, users(spark, a=1, b=2))
    assert counted(spark.table(f"{database}.user_activity")) == {"a": 1, "b": 2}
    declared.replace(spark, database, schemas.USER_ACTIVITY, users(spark, c=3))
    assert counted(declared.read(spark, database, schemas.USER_ACTIVITY)) == {"c": 3}
    assert declared.read(spark, database, schemas.USER_ACTIVITY).schema == schemas.USER_ACTIVITY.schema


def test_a_table_of_another_form_is_refused(spark, folder, database):
    declared.declare(spark, database, schemas.USER_ACTIVITY.narrowed(), folder)
    for use in (
        lambda: declared.declare(spark, database, schemas.USER_ACTIVITY, folder),
        lambda: declared.replace(spark, database, schemas.USER_ACTIVITY, users(spark, a=1)),
    ):
        with pytest.raises(declared.WrongTable):
            use()
    spark.sql(f"CREATE TABLE {database}.toxic_users (user string, nb_toxic_messages bigint) USING parquet LOCATION '{folder}/x'")
    with pytest.raises(declared.WrongTable):
        declared.declare(spark, database, schemas.TOXIC_USERS)


@pytest.mark.parametrize("data", [[("a", 1), ("a", 2)], [(None, 1)]])
def test_a_declared_key_stands_once(spark, folder, database, data):
    declared.declare(spark, database, schemas.USER_ACTIVITY, folder)
    with pytest.raises(ValueError, match="key"):
        declared.replace(spark, database, schemas.USER_ACTIVITY, spark.createDataFrame(data, schemas.USER_ACTIVITY.schema))
    assert declared.read(spark, database, schemas.USER_ACTIVITY).count() == 0


def test_declarations_for_an_outside_store():
    text = declared.store_declarations("chat", [schemas.WINDOW_ACTIVITY, schemas.GLOBAL_STATS], replication=3)
    assert text.startswith("CREATE KEYSPACE IF NOT EXISTS chat WITH replication = {'class': 'SimpleStrategy', 'replication_factor': 3};")
    assert """CREATE TABLE IF NOT EXISTS chat.window_activity (
  "window_start" timestamp,
  "total_messages" int,
  PRIMARY KEY ("window_start")
);""" in text
    assert '"value" double' in text and text.count(";") == 3


def test_metric_log_appends_runs_and_repeats_safely(spark, folder):
    frame = spark.createDataFrame(
        [("a", 1, "messages_per_user"), ("x", 2, "top_words")],
        "key string, value bigint, metric string",
    )
    for run in (1, 2, 2):
        append_metrics(frame, f"{folder}/stats", run, "2024-01-01 00:00:00")
    log = read_metrics(spark, f"{folder}/stats")
    assert log.count() == 4
    assert log.columns == ["key", "value", "metric", "timestamp", "run"]


def test_connector_writer_conforms_to_the_declared_table(spark, folder):
    write = connector_writer(
        "parquet", {"path": f"{folder}/out"}, schemas.USER_ACTIVITY.narrowed()
    )
    write(users(spark, a=1), 0)
    write(users(spark, b=2), 1)
    out = spark.read.parquet(f"{folder}/out")
    assert rows(out) == [("a", 1), ("b", 2)]
    assert dict(out.dtypes) == {"user": "string", "nb_messages": "int"}
    assert cassandra_options("k", "t") == {"keyspace": "k", "table": "t"}


def test_split_writer_fills_two_tables(spark, folder):
    fused = spark.createDataFrame(
        [("a", 3, 1), ("b", 2, 0)],
        "user string, nb_messages bigint, nb_toxic_messages bigint",
    )
    totals = KeyedTable(f"{folder}/all", schemas.USER_ACTIVITY)
    toxic = KeyedTable(f"{folder}/toxic", schemas.TOXIC_USERS)
    split_writer(totals.writer(1), toxic.writer(1))(fused, 0)
    assert counted(totals.latest(spark)) == {"a": 3, "b": 2}
    assert counted(toxic.latest(spark)) == {"a": 1}


MESSAGES = [("a", "hi there", 1), ("a", "Hi!", 2), ("b", None, 3), (None, "ghost hi", 4)]


def write_archive(spark, path, messages):
    frame = chat(spark, *messages)
    archive.write_archive(frame.withColumn("timestamp", iso_text(frame.timestamp)), path)


def test_batch_job(spark, folder, capfd):
    source, history, tables = (f"{folder}/{n}" for n in ("a", "h", "t"))
    write_archive(spark, source, MESSAGES)
    batch_layer.run_batch(spark, source, history, tables)
    write_archive(spark, source, [("c", "hi you", 9)])
    batch_layer.run_batch(spark, source, history, tables, word_rank=2, preview=True)
    assert counted(batch_layer.current_users(spark, tables)) == {"a": 2, "b": 1, "c": 1}
    assert counted(batch_layer.current_words(spark, tables)) == {"hi": 3, "there": 1}
    totals = batch_layer.result_table(tables, schemas.GLOBAL_STATS)
    assert counted(totals.latest(spark)) == {
        "total_messages": 4.0, "average_messages_per_user": 4 / 3,
    }
    assert batch_layer.next_run(spark, tables) == 2


def test_an_empty_run_after_a_full_one(spark, folder, file_store):
    source, history, tables = (f"{folder}/{n}" for n in ("a", "h", "t"))
    write_archive(spark, source, MESSAGES)
    batch_layer.run_batch(spark, source, history, tables)
    write_archive(spark, f"{folder}/none", [])
    batch_layer.run_batch(spark, f"{folder}/none", history, tables)
    totals = batch_layer.result_table(tables, schemas.GLOBAL_STATS).newest_epoch(spark, 1)
    assert counted(totals) == {"total_messages": 0.0, "average_messages_per_user": 0.0}
    assert batch_layer.current_users(spark, tables).count() == 0
    batch_layer.export_results(spark, tables, "store", form="parquet")
    assert spark.read.schema("user string").parquet(f"{folder}/store/top_users").count() == 0
    assert {r.value for r in spark.read.parquet(f"{folder}/store/global_stats").collect()} == {0.0}


def test_users_of_the_last_run_agree_with_its_statistics(spark, folder):
    tables = f"{folder}/t"
    for run, messages in enumerate(([("a", "x", 1)], [("b", "y", 2), ("b", "z", 3)])):
        batch_layer.write_results(chat(spark, *messages), tables, run)
    assert counted(batch_layer.current_users(spark, tables)) == {"b": 2}
    totals = batch_layer.result_table(tables, schemas.GLOBAL_STATS).newest_epoch(spark, 1)
    assert counted(totals)["total_messages"] == 2.0


@pytest.fixture
def file_store(folder, monkeypatch):
    """Folders in place of an outside store's tables."""
    monkeypatch.setattr(
        connectors, "cassandra_options", lambda keyspace, table: {"path": f"{folder}/{keyspace}/{table}"}
    )


def test_batch_results_go_to_an_outside_store(spark, folder, file_store):
    source, history, tables = (f"{folder}/{n}" for n in ("a", "h", "t"))
    write_archive(spark, source, MESSAGES)
    batch_layer.run_batch(spark, source, history, tables)
    batch_layer.export_results(spark, tables, "store", "parquet", {"top_users": "batch_users"})
    stored = spark.read.parquet(f"{folder}/store/batch_users")
    assert counted(stored) == {"a": 2, "b": 1}
    assert dict(stored.dtypes)["nb_messages"] == "int"
    assert counted(spark.read.parquet(f"{folder}/store/top_words")) == {"hi": 2, "there": 1}
    assert spark.read.parquet(f"{folder}/store/global_stats").count() == 2


def test_metric_log_goes_to_an_outside_store(spark, folder, file_store):
    source, history, tables = (f"{folder}/{n}" for n in ("a", "h", "t"))
    write_archive(spark, source, MESSAGES)
    arguments = ["--archive", source, "--history", history, "--tables", tables, "--metric-log"]
    batch_layer.main([*arguments, "--keyspace", "store", "--store", "parquet", "--table-names", "messages=raw,stats=log"])
    assert spark.read.parquet(f"{folder}/store/raw").count() == len(MESSAGES)
    log = spark.read.parquet(f"{folder}/store/log")
    assert log.count() == 5 and dict(log.dtypes)["value"] == "int"


@pytest.mark.parametrize("more", [["--table-names", "a=b"], ["--keep-history"]])
def test_options_that_would_do_nothing_are_refused(folder, more):
    with pytest.raises(SystemExit):
        batch_layer.main(["--archive", folder, "--history", folder, "--tables", folder, *more])


def test_metric_log_reads_what_came_since(spark, folder):
    source, history, tables = (f"{folder}/{n}" for n in ("a", "h", "t"))
    for run, keep in ((1, False), (2, False), (3, True)):
        write_archive(spark, source, [(f"u{run}", "hi", run)])
        batch_layer.run_metric_log(spark, source, history, tables, run, "2024-01-01 00:00:00", keep_history=keep)
    log = read_metrics(spark, f"{tables}/stats").filter("metric = 'messages_per_user'")
    assert rows(log.select("run", "key")) == [(1, "u1"), (2, "u1"), (2, "u2"), (3, "u1"), (3, "u2")]


def test_metric_log_job_keeps_null_users_as_messages_but_counts_them_for_nobody(spark, folder):
    source, history, tables = (f"{folder}/{n}" for n in ("a", "h", "t"))
    write_archive(spark, source, MESSAGES)
    batch_layer.run_metric_log(spark, source, history, tables, 1, "2024-01-01 00:00:00", True)
    assert spark.read.parquet(f"{tables}/messages").count() == len(MESSAGES)
    log = read_metrics(spark, f"{tables}/stats")
    assert counted(log.filter("metric = 'messages_per_user'").select("key", "value")) == {
        "a": 2, "b": 1,
    }
    assert counted(log.filter("metric = 'top_words'").select("key", "value")) == {
        "hi": 3, "there": 1, "ghost": 1,
    }


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_counts_beyond_the_declared_type_raise(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        narrow = schemas.USER_ACTIVITY.narrowed()
        assert counted(narrow.conform(users(spark, a=2**31 - 1))) == {"a": 2**31 - 1}
        with pytest.raises(Exception, match="beyond 32 bits"):
            narrow.conform(users(spark, a=2**31 + 5)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_work_folders_go_when_told(spark):
    before = work_folder(spark, "gone")
    users(spark, a=1).write.parquet(before)
    assert remove_work_folders(spark) >= 1
    assert not Path(before).exists() and remove_work_folders(spark) == 0


def test_work_folders_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(f"{root}/x-")
