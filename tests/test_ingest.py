"""Golden rows of line parsing and payloads; archive conversion; topics."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chatpulse.operators import activity, ingest
from chatpulse.plans import ingest_layer
from chatpulse.sources import archive, raw, topics
from chatpulse.streaming.run import finish, start
from helpers import rows

LINES = {
    ":bob!b@h PRIVMSG #c :  hi: there  ": ("bob", "hi: there"),
    ":tmi PRIVMSG #c :x": ("tmi ", "x"),
    ":a!b PRIVMSG #c :say PRIVMSG :z": ("a", "say PRIVMSG :z"),
    ":d!d@h PRIVMSG #c : \x1cwide　": ("d", "wide"),
    ":e!e@h PRIVMSG #c :": ("e", ""),
    ":bob!b@h PRIVMSG #c nocolon": None,
    "PING :tmi": None,
    ":a!b JOIN #c": None,
    "": None,
}


def test_lines(spark):
    chunk = "\r\n".join([":server 001 :hello", *LINES, ""])
    frame = spark.createDataFrame([(chunk.encode(),)], "chunk binary")
    got = rows(ingest.parse_chat_lines(ingest.chat_lines(frame)))
    assert got == sorted((v for v in LINES.values() if v), key=repr)


def chunks_of(spark, *chunks):
    """``chunk, begins``; a chunk given in a tuple is known to begin a line."""
    data = [(c[0], True) if isinstance(c, tuple) else (c, False) for c in chunks]
    return spark.createDataFrame(data, "chunk string, begins boolean")


def test_only_the_keepalive_line_of_a_chunk_is_skipped(spark):
    frame = chunks_of(spark, ("PING :x PRIVMSG #c :y\r\n:bob!b@h PRIVMSG #c :kept\r\n",), None)
    judged = ingest.judged_pieces(frame, begins="begins")
    assert rows(ingest.messages_of(judged)) == [("bob", "kept")]
    assert rows(ingest.set_aside(judged)) == [("PING :x PRIVMSG #c :y", "keep-alive")]
    assert ingest.cut_lines(frame, begins="begins").count() == 0


def test_lines_cut_by_a_chunk_border_are_set_aside(spark):
    chunks = [":a!a@h PRIVMSG #c :one\r\n:b!b@h PRIVMSG #c :hello wor", "ld\r\n:c!c@h PRIVMSG #c :two\r\n", "PING :h"]
    frame = spark.createDataFrame([(c,) for c in chunks], "chunk string")
    # Nothing says that the first chunk begins a line.
    assert rows(ingest.parse_chat_lines(ingest.chat_lines(frame))) == [("c", "two")]
    assert rows(ingest.cut_lines(frame)) == [
        (":a!a@h PRIVMSG #c :one",), (":b!b@h PRIVMSG #c :hello wor",), ("PING :h",), ("ld",),
    ]
    known = chunks_of(spark, (chunks[0],), *chunks[1:])
    assert rows(ingest.parse_chat_lines(ingest.chat_lines(known, begins="begins"))) == [("a", "one"), ("c", "two")]


@pytest.mark.parametrize(
    "first, second",
    [
        (":bob!bob@h PRIVMSG #r ", ":lost one\r\n"),
        (":bob!bob@h PRIVMSG #r :", "PING me later\r\n"),
        (":bob!bob@h PRIVMSG #r :", ":x!x@h PRIVMSG #r :quoted\r\n"),
        (":bob!bob@h PRIVMSG #r :text\r", "\n:amy!a@h PRIVMSG #r :hi\r\n"),
        (":bob!bob@h PRIVMSG #r :text", "\r\n:amy!a@h PRIVMSG #r :hi\r\n"),
    ],
)
def test_no_piece_of_a_cut_line_is_lost_or_taken_for_a_message(spark, first, second):
    judged = ingest.judged_pieces(chunks_of(spark, (first,), second), begins="begins")
    pieces = [p for c in (first, second) for p in c.split("\r\n") if p]
    assert sorted(r.line for r in judged.collect()) == sorted(pieces)
    aside = rows(ingest.set_aside(judged))
    assert (first, "cut") in aside and all(kind == "cut" for _, kind in aside)
    accepted = rows(ingest.messages_of(judged))
    assert len(accepted) + len(aside) == len(pieces)
    assert all(user == "amy" for user, _ in accepted)


def test_every_piece_has_an_outcome(spark):
    """Random cuts of a line sequence: messages and what is set aside make up all pieces."""
    rng = random.Random(2)
    lines = [":a!a@h PRIVMSG #c :one", "PING :h", ":server 001 :hi", ":b!b@h PRIVMSG #c notext", ":c!c@h PRIVMSG #c :PING :x"]
    text = "".join(rng.choice(lines) + "\r\n" for _ in range(200))
    places = sorted(rng.sample(range(1, len(text)), 60))
    parts = [text[i:j] for i, j in zip([0, *places], [*places, len(text)])]
    begins = [i == 0 or text[:i].endswith("\r\n") for i in [0, *places]]
    frame = spark.createDataFrame(list(zip(parts, begins)), "chunk string, begins boolean")
    judged = ingest.judged_pieces(frame, begins="begins")
    pieces = [p for part in parts for p in part.split("\r\n") if p]
    assert sorted(r.line for r in judged.collect()) == sorted(pieces)
    assert ingest.messages_of(judged).count() + ingest.set_aside(judged).count() == len(pieces)
    whole = {kind: n for kind, n in judged.groupBy("kind").count().collect()}
    assert set(whole) == {"message", "no text", "keep-alive", "other", "cut"}
    assert {r.user for r in ingest.messages_of(judged).collect()} <= {"a", "c"}


def test_ingest_keeps_pieces_in_a_folder(spark, folder):
    frame = chunks_of(spark, (":a!a@h PRIVMSG #c :one\r\n:x!x@h PRIVMSG #c none\r\n:b!b@h PRIV",))
    ingest_layer.ingest(frame, topics.file_target(f"{folder}/topic"), f"{folder}/aside", "begins")
    assert rows(spark.read.parquet(f"{folder}/aside")) == [(":b!b@h PRIV", "cut"), (":x!x@h PRIVMSG #c none", "no text")]
    assert spark.read.parquet(f"{folder}/topic").count() == 1


def test_raw_files_are_read_line_by_line_wherever_tasks_divide_them(spark, folder):
    """Splits far shorter than a line, and line feeds inside of texts."""
    lines = [f":u{i}!u@h PRIVMSG #c :{'x' * (i * 7 % 300)}\n\r{i}" for i in range(500)]
    raw.write_raw(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), folder)
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "97")
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    read = raw.read_raw(own, folder)
    assert read.rdd.getNumPartitions() > 100
    assert sorted(r.line for r in read.collect()) == sorted(lines)
    query = raw.stream_raw(own, folder).writeStream.format("parquet").option("path", f"{folder}-out")
    finish(start(query, "append", f"{folder}-c", available_now=True))
    assert sorted(r.line for r in spark.read.parquet(f"{folder}-out").collect()) == sorted(lines)


def test_rejects_and_counts_of_every_trigger(spark, folder):
    target = topics.file_target(f"{folder}/topic")

    def add(*lines):
        raw.write_raw(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), f"{folder}/raw")

    def run():
        source = raw.stream_raw(spark, f"{folder}/raw")
        finish(*ingest_layer.start_lines(source, target, f"{folder}/rejects", f"{folder}/c", available_now=True))

    assert ingest_layer.read_counts(spark, f"{folder}/rejects").collect() == []
    add(":a!a@h PRIVMSG #c :one", "PING :h", ":b!b@h PRIVMSG #c none", "")
    run()
    add(":a!a@h PRIVMSG #c :two", ":s 001 :x", ":a!a@h PRIVMSG #c :three")
    run()
    run()
    counts = rows(ingest_layer.read_counts(spark, f"{folder}/rejects"))
    assert counts == [(3, 1, 1, 1, 0), (3, 2, 0, 1, 1)]
    assert rows(ingest_layer.read_rejects(spark, f"{folder}/rejects")) == [
        (":b!b@h PRIVMSG #c none", "no text", 0), (":s 001 :x", "other", 1), ("PING :h", "keep-alive", 0),
    ]
    assert spark.read.parquet(f"{folder}/topic").count() == 3


def test_ingest_job(spark, folder, capsys):
    raw.write_raw(spark.createDataFrame([(":a!a@h PRIVMSG #c :one",), ("x PRIVMSG",)], "line string"), f"{folder}/raw")
    ingest_layer.main(
        ["--raw", f"{folder}/raw", "--rejects", f"{folder}/r", "--checkpoints", f"{folder}/c",
         "--topic-folder", f"{folder}/t", "--available-now"]
    )
    assert "2 lines: 1 messages, 1 rejected" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        ingest_layer.main(["--raw", "x", "--rejects", "r", "--checkpoints", "c"])


PAYLOADS = [
    ('{"user":"a","message":"hi"}', ("a", "hi", None), True),
    ('{"user":"a","message":"hi","timestamp":"t"}', ("a", "hi", "t"), True),
    ('{"user":1,"message":{"x":1}}', ("1", '{"x":1}', None), True),
    ('{"message":"m"}', (None, "m", None), True),
    ('{"user":null,"message":"x","zzz":1}', (None, "x", None), True),
    ("not json", (None, None, None), False),
    ('x{"user":"a"}', (None, None, None), False),
    ("[1]", (None, None, None), False),
    ("null", (None, None, None), False),
    ("", (None, None, None), False),
    (None, (None, None, None), False),
]


@pytest.fixture
def payloads(spark):
    data = [(p if p is None else bytearray(p, "utf-8"),) for p, _, _ in PAYLOADS]
    return spark.createDataFrame(data, "value binary")


def test_decode(payloads):
    got = rows(ingest.decode_payload(payloads))
    assert got == sorted((r for _, r, _ in PAYLOADS), key=repr)


def test_decode_without_malformed(payloads):
    got = rows(ingest.decode_payload(payloads, drop_malformed=True))
    assert got == sorted((r for _, r, good in PAYLOADS if good), key=repr)


def test_quarantine(payloads):
    got = rows(ingest.quarantine(payloads).select(F.col("value").cast("string")))
    assert got == sorted(((p,) for p, _, good in PAYLOADS if not good), key=repr)


def test_payload_is_parsed_once_per_row(payloads):
    decoded = ingest.decode_payload(payloads)
    for frame in (
        ingest.quarantine(payloads),
        ingest.decode_payload(payloads, drop_malformed=True),
        activity.user_counts(activity.flag_toxic(decoded)),
    ):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_encode_is_json_bytes(spark):
    text = 'say "hi"\né \U0001f600 \\'
    frame = spark.createDataFrame([("a", text), ("b", None)], "user string, message string")
    got = [json.loads(bytes(r.value)) for r in ingest.encode_payload(frame).collect()]
    assert got == [{"user": "a", "message": text}, {"user": "b", "message": None}]


def test_archive_time_is_iso_text(spark):
    frame = spark.createDataFrame([("a", "x"), ("b", "y")], "user string, message string")
    stamped = ingest.stamp_archive_time(frame)
    assert stamped.columns == ["user", "message", "timestamp"]
    times = {r.timestamp for r in stamped.collect()}
    assert len(times) == 1
    assert stamped.filter("try_to_timestamp(timestamp) IS NULL").count() == 0


def test_archive_times_parse_and_bad_ones_become_null(spark, folder):
    records = [
        ("a", "x", "2026-04-06T02:58:11.278123"),
        ("b", "y", "2026-04-06T02:58:11"),
        ("c", "z", "bad"),
        (None, None, None),
    ]
    frame = spark.createDataFrame(records, "user string, message string, timestamp string")
    archive.write_archive(frame, f"{folder}/a")
    archive.convert_archive(spark, f"{folder}/a", f"{folder}/h")
    history = archive.read_history(spark, f"{folder}/h")
    got = rows(history.select("user", F.col("timestamp").cast("string")))
    assert got == sorted(
        [
            ("a", "2026-04-06 02:58:11.278123"),
            ("b", "2026-04-06 02:58:11"),
            ("c", None),
            (None, None),
        ],
        key=repr,
    )


def test_broken_archive_line_keeps_the_schema(spark, folder):
    spark.createDataFrame(
        [('{"user":"a","message":"m","timestamp":"2026-01-01T00:00:00"}',), ("{broken",)],
        "value string",
    ).write.text(f"{folder}/a")
    read = archive.read_archive(spark, f"{folder}/a")
    assert read.columns == ["user", "message", "timestamp"]
    assert read.count() == 1
    archive.convert_archive(spark, f"{folder}/a", f"{folder}/h")
    assert [r.user for r in archive.read_history(spark, f"{folder}/h").collect()] == ["a"]
    assert rows(archive.read_rejected(spark, f"{folder}/h")) == [("{broken",)]


def test_convert_if_absent_keeps_what_is_there(spark, folder):
    first = spark.createDataFrame([("a", "x", "t")], "user string, message string, timestamp string")
    archive.write_archive(first, f"{folder}/a")
    archive.convert_archive(spark, f"{folder}/a", f"{folder}/h", only_if_absent=True)
    archive.write_archive(first, f"{folder}/a")
    archive.convert_archive(spark, f"{folder}/a", f"{folder}/h", only_if_absent=True)
    assert archive.read_history(spark, f"{folder}/h").count() == 1
    archive.convert_archive(spark, f"{folder}/a", f"{folder}/h")
    assert archive.read_history(spark, f"{folder}/h").count() == 2


def test_a_history_without_its_marker_is_written_anew(spark, folder):
    record = spark.createDataFrame([("a", "x", "t")], "user string, message string, timestamp string")
    archive.write_archive(record, f"{folder}/a")
    Path(f"{folder}/h/_temporary/0").mkdir(parents=True)
    archive.convert_archive(spark, f"{folder}/a", f"{folder}/h", only_if_absent=True)
    assert archive.read_history(spark, f"{folder}/h").count() == 1


def test_kafka_options():
    assert topics.kafka_options("h:1", "room") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "room",
        "startingOffsets": "earliest",
    }
    limited = topics.kafka_options(
        "h:1", "room", max_offsets_per_trigger=5, min_partitions=64, extra={"failOnDataLoss": "false"}
    )
    assert limited["maxOffsetsPerTrigger"] == "5"
    assert limited["minPartitions"] == "64"
    assert limited["failOnDataLoss"] == "false"
    assert topics.kafka_target("h:1", "room") == (
        "kafka", {"kafka.bootstrap.servers": "h:1", "topic": "room"},
    )


def test_ingest_stream_publishes_payloads(spark, folder):
    chunk = ":a!a@h PRIVMSG #c :one\r\n:b!b@h PRIVMSG #c :two\r\n"
    chunks_of(spark, (chunk,), "PING :x").write.parquet(f"{folder}/raw")
    chunks = spark.readStream.schema("chunk string, begins boolean").parquet(f"{folder}/raw")
    target = topics.file_target(f"{folder}/topic")
    judged = ingest.judged_pieces(chunks, begins="begins")
    finish(ingest_layer.start_ingest(judged, target, f"{folder}/checkpoint", available_now=True))
    published = spark.read.schema(topics.VALUE).parquet(f"{folder}/topic")
    assert rows(ingest.decode_payload(published)) == [("a", "one", None), ("b", "two", None)]
