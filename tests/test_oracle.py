"""Every registered query against its DuckDB counterpart."""

import pytest

import __spark_entry__ as entry_point

from editscope.plans import catalog, oracle

from .compare import assert_same, connect

# Five-minute windows hold little of the small tables' thirty days.
SPARSE = {"edit_wars_5m", "super_editors_5m", "topic_trends_5m"}
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_duckdb(spark, sf_dir, db, name):
    rows = assert_same(QUERIES[name](spark, sf_dir), db, ORACLE[name])
    assert rows > 0 or name in SPARSE


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)


@pytest.mark.parametrize("name", ["suspicious_flag_hot", "suspicious_flag_fast", "feed_to_wars", "hist_read_topics"])
def test_queries_that_must_find_something(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    assert (rows.filter("is_suspicious") if name.startswith("suspicious") else rows).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() == 12
