"""Every query with a SQL statement agrees with it, value by value."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry_runs(spark):
    result = entry(spark)
    assert result.columns == ["target_variable", "n"]
    assert result.count() == 2
