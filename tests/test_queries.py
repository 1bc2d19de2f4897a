"""Every query that has SQL gives the same rows as it, over the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, con, name):
    _, _, more, less = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF, con)
    assert not more and not less, (list(more.items())[:3], list(less.items())[:3])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
