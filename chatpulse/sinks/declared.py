"""Result tables declared by name: in Spark's catalog, and as text for an outside store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

from chatpulse.schemas import ResultTable

_KEY = "chat.key"

# Names of types in the query language of the outside store.
_STORE_TYPES = {
    T.TimestampType(): "timestamp",
    T.StringType(): "text",
    T.IntegerType(): "int",
    T.LongType(): "bigint",
    T.DoubleType(): "double",
}


class WrongTable(ValueError):
    """A table of that name has another key, other columns or other types."""


def _quoted(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def declare(spark: SparkSession, database: str, table: ResultTable, location: str | None = None) -> str:
    """Creates the table with its key and types if it is absent; its full name.

    One that is there must have the same key, columns and types: rows in another
    form would be read as something they are not.
    """
    name = _quoted(database, table.name)
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in table.schema.fields)
    where = f" LOCATION {_text(f'{location}/{table.name}')}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where} TBLPROPERTIES ({_text(_KEY)} = {_text(table.key.name)})"
    )
    check(spark, database, table)
    return name


def check(spark: SparkSession, database: str, table: ResultTable) -> None:
    """Raises ``WrongTable`` if the table that is there is not the declared one."""
    name = _quoted(database, table.name)
    found = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
    wanted = [(f.name, f.dataType.simpleString()) for f in table.schema.fields]
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if found != wanted or properties.get(_KEY) != table.key.name:
        raise WrongTable(f"{name} has key {properties.get(_KEY)} and {found}, not {table.key.name} and {wanted}")


def replace(spark: SparkSession, database: str, table: ResultTable, rows: DataFrame) -> None:
    """Makes the rows the content of a declared table; a key that stands twice or is null is an error."""
    check(spark, database, table)
    conformed = table.conform(rows)
    key = table.key.name
    broken = conformed.groupBy(key).count().filter(f"count > 1 OR {_quoted(key)} IS NULL").limit(1).collect()
    if broken:
        raise ValueError(f"{table.name}: key {broken[0][0]!r} is null or stands {broken[0][1]} times")
    conformed.write.mode("overwrite").insertInto(_quoted(database, table.name))


def read(spark: SparkSession, database: str, table: ResultTable) -> DataFrame:
    return spark.table(_quoted(database, table.name))


def store_declarations(keyspace: str, tables: Iterable[ResultTable], replication: int = 1) -> str:
    """Statements that create the tables in an outside store, with the 32-bit counts that writers send.

    Spark's connectors write to tables that are there; this text makes them, in
    the store's own shell.
    """
    made = [
        f"CREATE KEYSPACE IF NOT EXISTS {keyspace} WITH replication = "
        f"{{'class': 'SimpleStrategy', 'replication_factor': {replication}}};"
    ]
    for table in (t.narrowed() for t in tables):
        columns = [f'  "{f.name}" {_STORE_TYPES[f.dataType]}' for f in table.schema.fields]
        key = f'  PRIMARY KEY ("{table.key.name}")'
        made.append(f"CREATE TABLE IF NOT EXISTS {keyspace}.{table.name} (\n" + ",\n".join([*columns, key]) + "\n);")
    return "\n".join(made) + "\n"
