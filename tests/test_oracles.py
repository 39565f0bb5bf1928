"""Every query that has SQL gives the SQL's result."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, folder, name):
    assert compare(QUERIES[name](spark, folder), duck, ORACLES[name]) == []


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
