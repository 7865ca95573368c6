"""Every registered query against its DuckDB statement on the smallest data folder."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect
from mealmarts import registry

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, duck, key):
    assert compare(entry.queries()[key](spark, FOLDER), duck, SQL[key]) == ""


def test_catalogue():
    assert set(registry.all_queries()) <= set(SQL)
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "food_name", "food_score", "rank_order", "score_type"]
    assert df.count() > 0
