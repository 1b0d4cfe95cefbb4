"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from checks import catalog

SF = Path("/root/testdata/sf0.001")
QUERIES = entry_module.queries()
STATEMENTS = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((x is not None, x if x is not None else 0) for x in row)
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=key)


def test_names_agree():
    """Only queries of the subpackage, which has tests of its own, go without SQL."""
    assert set(STATEMENTS) <= set(QUERIES)
    assert set(catalog.registered()) <= set(STATEMENTS)


@pytest.mark.parametrize("name", STATEMENTS)
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, str(SF))
    expected = duck.execute(STATEMENTS[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert table(result.collect(), result.columns) == table(expected.fetchall(), columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
