"""From socket chunks to messages, and from messages to payloads and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chatpulse.functions.payload import decoded, encoded
from chatpulse.functions.protocol import (
    KEEPALIVE_COMMAND,
    LINE_BREAK,
    MESSAGE_COMMAND,
    sender,
    spoken_text,
)
from chatpulse.schemas import CHAT, CHAT_OR_CORRUPT, CORRUPT

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# Kinds of lines and pieces of lines.
MESSAGE, NO_TEXT, KEEPALIVE, OTHER, CUT = "message", "no text", "keep-alive", "other", "cut"
#: Outcomes of the kinds: every line has one of them.
OUTCOMES = {MESSAGE: "accepted", NO_TEXT: "rejected", CUT: "rejected", KEEPALIVE: "other", OTHER: "other"}


def line_kind(line: Column) -> Column:
    """What a whole line is: a message, one without a text, a keep-alive, or another command."""
    return (
        F.when(line.startswith(KEEPALIVE_COMMAND), KEEPALIVE)
        .when(~line.contains(MESSAGE_COMMAND), OTHER)
        .when(spoken_text(line).isNull(), NO_TEXT)
        .otherwise(MESSAGE)
    )


def judged_pieces(chunks: DataFrame, chunk: str = "chunk", begins: str | None = None) -> DataFrame:
    """``line, kind`` of what stands between line breaks; empty pieces are none.

    The last piece of a chunk has no line break after it, so it is cut. The first
    one may be the rest of a line whatever it begins with: a text can begin like a
    command. It is whole only if the chunk is known to begin a line, which the
    boolean column ``begins`` says; without one no chunk is.
    """
    known = F.coalesce(F.col(begins), F.lit(False)) if begins else F.lit(False)
    pieces = chunks.select(F.split(F.col(chunk).cast("string"), LINE_BREAK).alias("pieces"), known.alias("known"))
    placed = pieces.select("known", F.size("pieces").alias("n"), F.posexplode("pieces").alias("place", "line"))
    is_cut = (F.col("place") == F.col("n") - 1) | ((F.col("place") == 0) & ~F.col("known"))
    kind = F.when(is_cut, CUT).otherwise(line_kind(F.col("line")))
    return placed.filter(F.col("line") != "").select("line", kind.alias("kind"))


def judged_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """``line, kind`` of lines that are whole, as a source that splits at line breaks gives them."""
    whole = lines.select(F.col(line).cast("string").alias("line")).filter(F.col("line") != "")
    return whole.withColumn("kind", line_kind(F.col("line")))


def messages_of(judged: DataFrame) -> DataFrame:
    """``user, message`` of the judged lines that are messages."""
    return parse_chat_lines(judged.filter(F.col("kind") == MESSAGE))


def set_aside(judged: DataFrame) -> DataFrame:
    """``line, kind`` of every judged line or piece that is no message: with the messages, all of them."""
    return judged.filter(F.col("kind") != MESSAGE)


def chat_lines(chunks: DataFrame, chunk: str = "chunk", begins: str | None = None) -> DataFrame:
    """One row per whole message line; keep-alives and other lines are skipped one by one."""
    return judged_pieces(chunks, chunk, begins).filter(F.col("kind").isin(MESSAGE, NO_TEXT)).drop("kind")


def cut_lines(chunks: DataFrame, chunk: str = "chunk", begins: str | None = None) -> DataFrame:
    """The pieces of lines that chunk borders cut, or may have cut.

    A message is only known whole: putting pieces together would need all
    chunks of a connection in order in one task. A source that splits at line
    breaks (``sources.raw``) makes none.
    """
    return judged_pieces(chunks, chunk, begins).filter(F.col("kind") == CUT).drop("kind")


def parse_chat_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """``user, message`` of each message line; lines without a text are left out (``set_aside`` has them)."""
    return lines.select(
        sender(F.col(line)).alias("user"), spoken_text(F.col(line)).alias("message")
    ).filter(F.col("message").isNotNull())


def encode_payload(messages: DataFrame, *fields: str) -> DataFrame:
    """One ``value`` column of JSON bytes, by default of ``user`` and ``message``."""
    return messages.select(encoded(*(fields or ("user", "message"))).alias("value"))


def _with_record(payloads: DataFrame, schema: T.StructType) -> DataFrame:
    # Exploding a one-element array keeps the parse in one place; Catalyst would
    # repeat a plain parsed column in every filter that looks at it.
    record = decoded(F.col("value"), schema)
    return payloads.withColumn("record", F.explode(F.array(record)))


def _is_malformed() -> Column:
    # Broken text decodes to a struct of nulls with the text beside them; null
    # and blank payloads decode to no struct at all.
    return F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()


def decode_payload(payloads: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """``user, message, timestamp`` of each payload; a broken one gives nulls."""
    if not drop_malformed:
        return _with_record(payloads, CHAT).select("record.*")
    whole = _with_record(payloads, CHAT_OR_CORRUPT).filter(~_is_malformed())
    return whole.select("record.*").drop(CORRUPT)


def flag_malformed(payloads: DataFrame) -> DataFrame:
    """The payloads with an ``is_malformed`` column."""
    whole = _with_record(payloads, CHAT_OR_CORRUPT)
    return whole.withColumn("is_malformed", _is_malformed()).drop("record")


def quarantine(payloads: DataFrame) -> DataFrame:
    """The payloads that do not decode, as they came."""
    return flag_malformed(payloads).filter("is_malformed").drop("is_malformed")


def iso_text(time: Column) -> Column:
    return F.date_format(time, ISO_MICROS)


def stamp_archive_time(messages: DataFrame) -> DataFrame:
    """Archive records: the message with the time it was taken in, as ISO text."""
    return messages.select("user", "message", iso_text(F.current_timestamp()).alias("timestamp"))
