"""Queries with SQL against DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(contract.LLM_ORACLE))
def test_query_equals_oracle(spark, name):
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = connection.execute(contract.LLM_ORACLE[name])
    columns = [d[0] for d in expected.description]
    result = contract.queries()[name](spark, DATA)
    assert sorted(result.columns) == sorted(columns)
    got = sorted((tuple(row) for row in result.select(*columns).collect()), key=repr)
    assert got == sorted(expected.fetchall(), key=repr) != []
