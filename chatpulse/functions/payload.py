"""JSON payloads on the wire."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from chatpulse.schemas import CHAT, CORRUPT


def encoded(*fields: str) -> Column:
    """UTF-8 bytes of a JSON object with the named columns, nulls included."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary")


def decoded(value: Column, schema: T.StructType = CHAT) -> Column:
    """Struct read from JSON bytes or text.

    Text that is no JSON object gives a struct of nulls; where the schema has a
    ``_corrupt_record`` field that field holds the text.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(value.cast("string"), schema, options)
