"""Every query with SQL gives the SQL's rows; the others give rows of a stable shape."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    panel = entry(spark)
    assert len(panel.columns) == 32
    assert panel.count() > 0
