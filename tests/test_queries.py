"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    sql = entry.oracle_sql()
    if name in sql:
        assert difference(spark, con, SF, name, entry.queries(), sql) is None
    else:
        assert entry.queries()[name](spark, SF).columns


def test_entry(spark):
    assert entry.entry(spark).count() == 199


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
