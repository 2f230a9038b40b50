"""Every named query against its SQL, on the smallest tables."""

import os

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SMALL)
    if name in oracle_sql():
        assert compare(df, duck, oracle_sql()[name]) == ""
    else:
        assert df.count() > 0
