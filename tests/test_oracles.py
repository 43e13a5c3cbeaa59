"""Every registered query equals its SQL on the smoke tables."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    from conftest import SMOKE

    return connect(SMOKE)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, queries()[name], SQL[name]) == []


def test_entry_is_the_hourly_summary(spark):
    frame = entry(spark)
    assert len(frame.columns) == 31
    assert frame.count() > 0


def test_every_library_query_has_sql():
    from tripstrata.plans.registry import QUERIES

    assert set(QUERIES) <= set(SQL) <= set(queries())
