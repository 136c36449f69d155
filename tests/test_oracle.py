"""Every registered query against DuckDB on the small tables."""

import pytest

import __spark_entry__
from tripmart.checks import ORACLES, QUERIES
from tripmart.checks.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.count() == 10
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
