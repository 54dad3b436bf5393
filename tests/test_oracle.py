"""Every registered query against its SQL, both over the whole test tables."""

import math
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry
import inspection_fixtures as fixtures
from tests.conftest import SF_DIR

QUERIES, ORACLES = entry.core_queries(), entry.core_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in fixtures.TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def _plain(value):
    """Comparable across engines: types kept apart, NULL and NaN equal to themselves."""
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, (date, datetime)):
        return ("t", value.isoformat())
    return (type(value).__name__, value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    rows = result.collect()
    assert rows
    assert _bag(result.columns, rows) == _bag(expected.columns, expected.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 35
    assert df.count() > 0
