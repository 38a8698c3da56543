"""Every named query with SQL gives the same rows in DuckDB, on the smallest data."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

_SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(_SQL))
def test_same_rows(spark, tiny, con, name):
    assert differences(entry.queries()[name](spark, tiny), con, _SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(_SQL)))
def test_runs(spark, tiny, name):
    assert entry.queries()[name](spark, tiny).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000 and "error_under_stress" in df.columns
