"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracles.compare import connect, difference
from tests.conftest import DATA


@pytest.fixture(scope="module")
def database():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, database, name):
    df = queries()[name](spark, DATA)
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(df.collect()) > 0
    else:
        assert difference(df, database, sql) is None


def test_entry_and_names(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["split", "n_rows", "accuracy"]
