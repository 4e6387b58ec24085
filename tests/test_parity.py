"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.parity import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    run, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert run(spark, FOLDER).count() > 0
    else:
        problems = [p for p in compare(spark, con, run, sql, FOLDER) if p != "no rows"]
        assert problems == []


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
