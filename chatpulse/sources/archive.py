"""The JSON-lines archive and the Parquet history made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from chatpulse.functions.payload import decoded
from chatpulse.schemas import CHAT, CHAT_OR_CORRUPT, CORRUPT
from chatpulse.sources.folders import is_complete
from chatpulse.streaming.run import start


def _parsed(lines: DataFrame) -> DataFrame:
    """Every line but blank ones, parsed once; one that is no JSON object is all null beside its text."""
    lines = lines.filter(F.trim("value") != "")
    # Exploding a one-element array keeps the parse in one place.
    parsed = lines.select("value", F.explode(F.array(decoded(F.col("value"), CHAT_OR_CORRUPT))).alias("record"))
    broken = F.when(F.col("record").isNull(), F.col("value")).otherwise(F.col(f"record.{CORRUPT}"))
    return parsed.select(*(F.col(f"record.{name}") for name in CHAT.names), broken.alias(CORRUPT))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``user, message, timestamp`` as text; a fixed schema saves a pass over the data.

    A line that is no JSON object is no record; ``convert_archive`` keeps it aside.
    """
    return _parsed(spark.read.text(path)).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def write_archive(records: DataFrame, path: str) -> None:
    """Appends archive records (the time already ISO text) as JSON lines."""
    records.select(*CHAT.names).write.mode("append").json(path, ignoreNullFields=False)


def convert_archive(
    spark: SparkSession, archive: str, history: str, only_if_absent: bool = False
) -> None:
    """Rewrites the archive as Parquet; or leaves a history that is whole alone.

    One pass writes every line: broken ones keep their text in a column of their
    own, which ``read_rejected`` shows. A history without its success marker is
    what a run left that did not end, and is written anew.
    """
    if only_if_absent and is_complete(spark, history):
        return
    _parsed(spark.read.text(archive)).write.mode("overwrite").parquet(history)


def start_conversion(
    spark: SparkSession, archive: str, history: str, checkpoint: str, max_files_per_trigger: int | None = None, **trigger
) -> StreamingQuery:
    """Adds the archive files that no run has converted yet to a history.

    The checkpoint knows the files that were read, and the history those that were
    written whole, so a run that is repeated, or that died, adds no line twice. By
    default it ends once it has read what is there. ``read_history`` and
    ``read_rejected`` read the history as they read one of ``convert_archive``; a
    history has one writer, either of the two.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = _parsed(reader.load(archive).select("value")).writeStream.format("parquet").option("path", history)
    return start(writer, "append", checkpoint, **(trigger or {"available_now": True}))


def _read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHAT_OR_CORRUPT).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet history with a real timestamp; unreadable times become null."""
    records = _read_rows(spark, path).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return records.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """``line``: the archive lines of a history that were no records."""
    broken = _read_rows(spark, path).filter(F.col(CORRUPT).isNotNull())
    return broken.select(F.col(CORRUPT).alias("line"))
