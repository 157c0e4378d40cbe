"""Raw chat traffic: files of the bytes as they came, lines ended by the protocol's break.

Spark's text reader splits at the line break wherever a file is divided among
tasks, so no line is cut, however long the file and wherever a chunk ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chatpulse.functions.protocol import LINE_BREAK


def write_raw(lines: DataFrame, folder: str) -> None:
    """Appends lines (the first column, without their breaks) to a folder of raw files."""
    lines.select(F.col(lines.columns[0]).alias("value")).write.mode("append").text(folder, lineSep=LINE_BREAK)


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """``line`` of every line of the folder."""
    return spark.read.text(folder, lineSep=LINE_BREAK).withColumnRenamed("value", "line")


def stream_raw(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of ``line``; files are taken whole, in order of modification time."""
    reader = spark.readStream.format("text").option("lineSep", LINE_BREAK)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder).select(F.col("value").alias("line"))
