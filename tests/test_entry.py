"""The order queries against SQL on the smallest given tables. Those of the optional subpackage have their own tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries  # noqa: E402
from check import compare, connect  # noqa: E402
from orderloom.samples import queries as order_queries, tables as given  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SMOKE_DIR)


def test_entry(spark):
    assert entry(spark).columns == ["category", "total_orders", "total_revenue", "avg_order_value",
                                    "total_items_sold"]


def test_every_query_has_sql():
    assert set(order_queries.QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(order_queries.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(queries()[name](spark, SMOKE_DIR), con, oracle_sql()[name]) == ""


@pytest.mark.parametrize("fact, key, dimension, column", [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
])
def test_given_foreign_keys_are_complete(spark, fact, key, dimension, column):
    """Adapters leave out joins they need no column of; that is only right with complete, unique keys."""
    facts = given.table(spark, SMOKE_DIR, fact)
    keys = given.table(spark, SMOKE_DIR, dimension).select(column)
    assert facts.join(keys, facts[key] == keys[column], "left_anti").count() == 0
    assert keys.distinct().count() == keys.count()
