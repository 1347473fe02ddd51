"""Every query with SQL must give the rows DuckDB gives."""

import os

import pytest
from oracle import compare, duck

from mergewell.queries import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_same_rows_as_sql(spark, connection, name):
    assert compare(all_queries()[name](spark, FOLDER), connection, all_oracles()[name]) == ""


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
