"""Message schemas and the registry of result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A chat message as published, and as archived (the time is an ISO string).
PAYLOAD = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
CHAT = T.StructType([*PAYLOAD.fields, T.StructField("timestamp", T.StringType())])

CORRUPT = "_corrupt_record"
CHAT_OR_CORRUPT = T.StructType([*CHAT.fields, T.StructField(CORRUPT, T.StringType())])


@dataclass(frozen=True)
class ResultTable:
    """Name, key column and value columns of one keyed result table."""

    name: str
    key: T.StructField
    values: tuple[T.StructField, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([self.key, *self.values])

    def narrowed(self) -> "ResultTable":
        """The same table with 32-bit counts, for stores that declare ``int``."""
        fields = tuple(
            T.StructField(f.name, T.IntegerType()) if f.dataType == T.LongType() else f
            for f in self.values
        )
        return ResultTable(self.name, self.key, fields)

    def conform(self, df: DataFrame) -> DataFrame:
        """Columns in declared order and type; a missing or spare column is an error.

        A count beyond a declared ``int`` raises instead of wrapping, whatever
        the session's cast rules are.
        """
        if set(df.columns) != set(self.schema.names):
            raise ValueError(
                f"{self.name}: expected {self.schema.names}, got {df.columns}"
            )
        return df.select(*(_cast(df, f).alias(f.name) for f in self.schema.fields))


def _cast(df: DataFrame, field: T.StructField) -> Column:
    column = F.col(field.name)
    if field.dataType == T.IntegerType() and df.schema[field.name].dataType == T.LongType():
        wide = F.concat(F.lit(f"{field.name} is beyond 32 bits: "), column.cast("string"))
        column = F.when(column.between(-(2**31), 2**31 - 1), column).when(
            column.isNotNull(), F.raise_error(wide).cast("bigint")
        )
    return column.cast(field.dataType)


def _table(name: str, key: str, key_type: T.DataType, **values: T.DataType) -> ResultTable:
    return ResultTable(
        name,
        T.StructField(key, key_type),
        tuple(T.StructField(n, t) for n, t in values.items()),
    )


# Counts are bigint: one busy user of a long history passes 2^31 messages.
_TIME, _TEXT, _COUNT, _REAL = (
    T.TimestampType(),
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
)

WINDOW_ACTIVITY = _table("window_activity", "window_start", _TIME, total_messages=_COUNT)
TOXIC_WINDOW_ACTIVITY = _table(
    "toxic_window_activity", "window_start", _TIME, total_toxic_messages=_COUNT
)
MINUTE_ACTIVITY = _table("minute_activity", "window_start", _TIME, n=_COUNT)
USER_ACTIVITY = _table("user_activity", "user", _TEXT, nb_messages=_COUNT)
TOXIC_USERS = _table("toxic_users", "user", _TEXT, nb_toxic_messages=_COUNT)
TOP_USERS = _table("top_users", "user", _TEXT, nb_messages=_COUNT)
TOP_WORDS = _table("top_words", "word", _TEXT, count=_COUNT)
GLOBAL_STATS = _table("global_stats", "metric_name", _TEXT, value=_REAL)

# The streams keep total and toxic counts of a key in one row.
WINDOW_COUNTS = _table(
    "window_counts", "window_start", _TIME, total_messages=_COUNT, total_toxic_messages=_COUNT
)
USER_COUNTS = _table(
    "user_counts", "user", _TEXT, nb_messages=_COUNT, nb_toxic_messages=_COUNT
)

# Append-only log of metrics from several runs.
METRIC_LOG = T.StructType(
    [
        T.StructField("key", _TEXT),
        T.StructField("value", _COUNT),
        T.StructField("metric", _TEXT),
        T.StructField("timestamp", _TIME),
    ]
)
METRIC_LOG_TABLE = ResultTable("stats", METRIC_LOG["key"], tuple(METRIC_LOG.fields[1:]))
MESSAGES = _table("messages", "user", _TEXT, message=_TEXT, timestamp=_TIME)
