"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from tidemark import catalog
from compare import connect, differences

FOLDER = "/root/testdata/sf0.01"  # the smallest with rows past the cursors
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    if name in SQL:
        assert differences(df, duck, SQL[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(contract.queries())
