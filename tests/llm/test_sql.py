"""Operators that can be written in SQL against it."""

from __future__ import annotations

import pytest

from tallyproof.llm import queries
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_sql_belongs_to_queries():
    assert SQL.keys() <= queries.queries().keys()


@pytest.mark.parametrize("key", list(SQL))
def test_query_equals_sql(spark, duck, key):
    assert difference(spark, duck, queries.queries()[key], SQL[key], SF) is None
