"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["c_nationkey", "customers", "mean"]
    assert frame.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
