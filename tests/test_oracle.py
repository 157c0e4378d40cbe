"""Every registered query against DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from chatpulse.plans.catalog import CATALOG
from chatpulse.plans.oracle import ORACLE

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def cell(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert CATALOG.keys() == ORACLE.keys()
    assert CATALOG.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_oracle(spark, duck, name):
    result = contract.queries()[name](spark, DATA)
    expected = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    want = sorted_rows(columns, expected.fetchall())
    assert want
    assert sorted_rows(result.columns, [tuple(r) for r in result.collect()]) == want


def test_the_caller_s_session_stays_as_it_is(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        before = dict(spark.conf.getAll)
        contract.queries()["global_activity"](spark, DATA).count()
        assert dict(spark.conf.getAll) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns == ["window_start", "total_toxic_messages"]
    assert result.count() == 6
