"""Every registered query against its DuckDB statement."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, STATEMENTS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    difference, rows, _ = differences(spark, con, SF_DIR, QUERIES[name], STATEMENTS.get(name))
    assert difference == ""
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
