"""Writers that go through any Spark data source."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from chatpulse.operators.activity import total_part, toxic_part
from chatpulse.schemas import ResultTable

BatchWriter = Callable[[DataFrame, int], None]

# The public connector's format name.
CASSANDRA = "org.apache.spark.sql.cassandra"


def cassandra_options(keyspace: str, table: str) -> dict[str, str]:
    return {"keyspace": keyspace, "table": table}


def parse_names(given: str | None) -> dict[str, str]:
    """``ours=theirs,...`` as a mapping of table names."""
    return dict(pair.strip().split("=", 1) for pair in given.split(",")) if given else {}


def store_writer(
    form: str, keyspace: str, table: ResultTable, names: Mapping[str, str] | None = None
) -> BatchWriter:
    """Upserts into a table of an outside store, which may have another name there."""
    own = (names or {}).get(table.name, table.name)
    return connector_writer(form, cassandra_options(keyspace, own), table.narrowed())


def connector_writer(
    form: str, options: Mapping[str, str], table: ResultTable, mode: str = "append"
) -> BatchWriter:
    """Writes a batch of a declared table; append to a keyed store is an upsert there."""

    def write(batch: DataFrame, epoch: int) -> None:
        table.conform(batch).write.format(form).options(**options).mode(mode).save()

    return write


def split_writer(totals: BatchWriter, toxic: BatchWriter) -> BatchWriter:
    """Sends fused counts to two tables.

    The batch is kept while both are written, since reading it twice would run
    the stateful aggregate twice.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            totals(total_part(batch), epoch)
            toxic(toxic_part(batch), epoch)
        finally:
            batch.unpersist()

    return write
