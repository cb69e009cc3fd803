"""Every registered query with SQL gives the rows DuckDB gives, on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
