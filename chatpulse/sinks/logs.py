"""Append-only logs, one folder per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from chatpulse.schemas import METRIC_LOG
from chatpulse.sources.folders import numbered


def append_run(rows: DataFrame, path: str, run: int, *partitions: str) -> None:
    """Adds a run's rows; a repeated run replaces its own rows and no others."""
    rows.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/run={run}")


def append_metrics(rows: DataFrame, path: str, run: int, at: str) -> None:
    """Adds ``key, value, metric`` rows under the time of the run."""
    stamped = rows.withColumn("timestamp", F.to_timestamp(F.lit(at)))
    append_run(stamped.select(*METRIC_LOG.names), path, run, "metric")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All runs' metrics, with the run's number."""
    schema = T.StructType([*METRIC_LOG.fields, T.StructField("run", T.LongType())])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_epoch(rows: DataFrame, path: str, epoch: int) -> None:
    """Adds a trigger's rows; a trigger that runs again replaces its own rows and no others."""
    rows.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def read_epochs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all triggers that wrote to the end, with their numbers; none if there are no triggers."""
    whole = numbered(spark, path, "epoch")
    if not whole:
        return spark.createDataFrame([], f"{schema}, epoch bigint")
    reader = spark.read.schema(f"{schema}, epoch bigint").option("basePath", path)
    return reader.parquet(*(f"{path}/epoch={epoch}" for epoch in whole))
