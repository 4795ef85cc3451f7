"""Every named query against its SQL text, on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from docsieve.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, tables, name):
    assert compare(QUERIES[name](spark, FOLDER), tables, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
