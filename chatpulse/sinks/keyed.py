"""Keyed result tables as a Parquet log of epochs.

Each write lands in a folder of its own, ``generation=<g>/epoch=<e>``, and
replaces that folder when it is repeated, so a retried batch changes nothing.
The latest row of a key wins. Epochs of a stream start again at 0 when its
checkpoint is lost; the generation then goes up by one. Epochs that are closed
can be folded into one folder, ``folded=<g>-<e>``, while the stream runs.
Numbers come from the names of the folders, never from the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chatpulse.schemas import ResultTable
from chatpulse.sinks.connectors import BatchWriter
from chatpulse.sources import folders

_LOG_COLUMNS = (
    T.StructField("generation", T.LongType()),
    T.StructField("epoch", T.LongType()),
)
_EPOCH_BITS = 40


def _write_order() -> Column:
    # One bigint instead of a struct keeps the max_by buffers fixed-width, so
    # the view is a hash aggregate and not a sort.
    return F.shiftleft("generation", _EPOCH_BITS) + F.col("epoch")


@dataclass(frozen=True)
class KeyedTable:
    """One declared result table stored under ``path``."""

    path: str
    table: ResultTable

    def create_if_absent(self, spark: SparkSession) -> None:
        empty = spark.createDataFrame([], self.table.schema)
        empty.write.mode("ignore").parquet(self._folder(0, 0))

    def _folder(self, generation: int, epoch: int) -> str:
        return f"{self.path}/generation={generation}/epoch={epoch}"

    def generations(self, spark: SparkSession) -> list[int]:
        found = (n.removeprefix("generation=") for n in folders.names(spark, self.path) if n.startswith("generation="))
        return sorted(map(int, found))

    def epochs(self, spark: SparkSession, generation: int) -> list[int]:
        """The epochs of a generation that were written to the end, empty ones included."""
        return folders.numbered(spark, f"{self.path}/generation={generation}", "epoch")

    def folds(self, spark: SparkSession) -> list[tuple[int, int]]:
        """Generation and epoch up to which rows were folded, for each fold that is whole."""
        found = (n.removeprefix("folded=") for n in folders.names(spark, self.path) if n.startswith("folded="))
        whole = (n for n in found if folders.is_complete(spark, f"{self.path}/folded={n}"))
        return sorted(tuple(map(int, n.split("-"))) for n in whole)

    def _written(self, spark: SparkSession) -> list[tuple[int, int]]:
        return [(g, e) for g in self.generations(spark) for e in self.epochs(spark, g)]

    def log(self, spark: SparkSession) -> DataFrame:
        """The rows of the newest fold and all written after it, with generation and epoch."""
        folded = self.folds(spark)[-1:]
        after = [w for w in self._written(spark) if not folded or w > folded[0]]
        schema = T.StructType([*self.table.schema.fields, *_LOG_COLUMNS])
        parts = []
        if after:
            reader = spark.read.schema(schema).option("basePath", self.path)
            parts.append(reader.parquet(*(self._folder(*w) for w in after)))
        for generation, epoch in folded:
            parts.append(spark.read.schema(schema).parquet(f"{self.path}/folded={generation}-{epoch}"))
        if not parts:
            return spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].select(*schema.names).union(parts[1].select(*schema.names))

    def put(self, rows: DataFrame, generation: int, epoch: int) -> None:
        folder = self._folder(generation, epoch)
        self.table.conform(rows).write.mode("overwrite").parquet(folder)

    def writer(self, generation: int) -> BatchWriter:
        """A ``foreachBatch`` function that puts each trigger as one epoch."""

        def write(batch: DataFrame, epoch: int) -> None:
            self.put(batch, generation, epoch)

        return write

    def last_generation(self, spark: SparkSession) -> int:
        """The newest generation that has written something, be it no rows."""
        return max((g for g, _ in (*self._written(spark), *self.folds(spark))), default=0)

    def last_epoch(self, spark: SparkSession, generation: int) -> int | None:
        return max(self.epochs(spark, generation), default=None)

    def generation_for(self, spark: SparkSession, checkpoint: str) -> int:
        """The generation of a checkpoint; one that has none yet gets the next.

        The number is kept inside the checkpoint folder, so it is lost and
        replaced together with the epoch numbers it goes with.
        """
        record = f"{checkpoint}/generation"
        following = max(self.generations(spark), default=0) + 1
        spark.range(0, 1, 1, 1).select(F.lit(following).cast("bigint").alias("generation")).write.mode(
            "ignore"
        ).parquet(record)
        return spark.read.schema("generation bigint").parquet(record).first()[0]

    def latest(self, spark: SparkSession, generation: int | None = None) -> DataFrame:
        """The last written row of each key, over all generations or within one.

        Window tables filled in processing time need one generation: a rebuilt
        stream counts old messages again, in other windows.
        """
        log = self.log(spark)
        if generation is not None:
            log = log.filter(F.col("generation") == generation)
        order = _write_order()
        return log.groupBy(self.table.key.name).agg(
            *(F.max_by(f.name, order).alias(f.name) for f in self.table.values)
        )

    def largest(self, spark: SparkSession) -> DataFrame:
        """The largest value of each key over all generations, for counts that only grow.

        Windows of event time are the same in every generation: one that a
        rebuilt stream has not reached, or whose messages are gone from the
        topic, keeps the count it had.
        """
        return self.log(spark).groupBy(self.table.key.name).agg(
            *(F.max(f.name).alias(f.name) for f in self.table.values)
        )

    def at(self, spark: SparkSession, generation: int, epoch: int) -> DataFrame:
        """The rows of one write."""
        return spark.read.schema(self.table.schema).parquet(self._folder(generation, epoch))

    def newest_epoch(self, spark: SparkSession, generation: int) -> DataFrame:
        """The rows of the last write alone, none if that wrote none."""
        epoch = self.last_epoch(spark, generation)
        if epoch is None:
            return spark.createDataFrame([], self.table.schema)
        return self.at(spark, generation, epoch)

    def fold(self, spark: SparkSession, keep: int = 2) -> tuple[int, int] | None:
        """Folds closed epochs into one row a key and generation; where it folded to.

        The last ``keep`` epochs stay, as a stream may write its last one again.
        The folders that a fold replaces go with the next one, so a view that
        was opened before this fold can be read to its end. Safe beside a
        running stream, by one folder at a time.
        """
        newest = self.last_generation(spark)
        closed = [w for w in self._written(spark) if w[0] < newest]
        closed += [(newest, e) for e in self.epochs(spark, newest)[: -max(1, keep)]]
        done = self.folds(spark)
        if not closed or (done and closed[-1] <= done[-1]):
            return None
        generation, epoch = closed[-1]
        until = F.lit((generation << _EPOCH_BITS) + epoch)
        order = _write_order()
        rows = self.log(spark).filter(order <= until).groupBy(self.table.key.name, "generation")
        folded = rows.agg(
            *(F.max_by(f.name, "epoch").alias(f.name) for f in self.table.values), F.max("epoch").alias("epoch")
        )
        folded.write.mode("overwrite").parquet(f"{self.path}/folded={generation}-{epoch}")
        if done:
            for old in (w for w in closed if w <= done[-1]):
                folders.remove(spark, self._folder(*old))
            for old in done[:-1]:
                folders.remove(spark, f"{self.path}/folded={old[0]}-{old[1]}")
        return generation, epoch
