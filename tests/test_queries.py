"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from catalogflow.bindings.registry import QUERIES, SQL
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["item_id", "avgRating"]
