"""Every registered query against its SQL, on the smallest tables."""

import oracle
import pytest

from corpusprep.plans import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf, con):
    assert oracle.differences(QUERIES[name](spark, sf), con, SQL[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
