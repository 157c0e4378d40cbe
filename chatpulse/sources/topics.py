"""Message topics: Kafka, or a folder of Parquet files with a ``value`` column.

Both kinds give a frame with a binary ``value`` column, so everything after the
source is the same. Any other streaming frame with such a column works as well.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from chatpulse.streaming.run import start

VALUE = T.StructType([T.StructField("value", T.BinaryType())])


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; ``min_partitions`` splits a topic of few partitions."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options | dict(extra or {})


def read_kafka(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Stream of a Kafka topic; needs Spark's public Kafka connector on the class path."""
    options = kafka_options(servers, topic, **settings)
    return spark.readStream.format("kafka").options(**options).load().select("value")


def read_files(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a folder topic, in order of file modification time."""
    reader = spark.readStream.schema(VALUE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def kafka_target(servers: str, topic: str) -> tuple[str, dict[str, str]]:
    return "kafka", {"kafka.bootstrap.servers": servers, "topic": topic}


def file_target(folder: str) -> tuple[str, dict[str, str]]:
    return "parquet", {"path": folder}


def publish(payloads: DataFrame, target: tuple[str, Mapping[str, str]]) -> None:
    """Appends a batch of payloads to a topic."""
    form, options = target
    payloads.select("value").write.format(form).options(**options).mode("append").save()


def publish_stream(
    payloads: DataFrame,
    target: tuple[str, Mapping[str, str]],
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Appends payloads to a topic as they arrive."""
    form, options = target
    writer = payloads.select("value").writeStream.format(form).options(**options)
    return start(writer, "append", checkpoint, **trigger)
