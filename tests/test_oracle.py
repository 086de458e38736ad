"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.own_queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() <= SQL.keys() and len(QUERIES) == 41


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, duck, key):
    assert difference(spark, duck, QUERIES[key], SQL[key], SF) is None
