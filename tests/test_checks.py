"""Every registered query runs, and agrees with its SQL where it has some."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SMALL

QUERIES = entry.queries()
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_agrees_with_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SMALL), connection, CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
