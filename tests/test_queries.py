"""Every registered query gives the rows of its SQL counterpart."""

import pytest
from compare import differences, views

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return views(sf_dir)


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["user_id", "session_start", "left_id", "right_id", "text"]
