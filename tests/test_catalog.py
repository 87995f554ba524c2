"""Every registered query against its SQL at the smallest scale."""

import decimal
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "conversations")
# the training-text operators have tests of their own
QUERIES = {k: q for k, q in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float) and value == int(value):
        value = int(value)
    return str(value)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in row) for row in rows(df, *columns))
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "label" and len(rows(df)) == 2
