"""Physical plans of the queries: what reaches the scan, and what must not be in them."""

import os
import re

import pytest
from pyspark.sql import functions as F

from orderloom.operators.absent import held_keys
from orderloom.operators.dates import on_dates
from orderloom.operators.firsts import tag_first
from orderloom.operators.sized import broadcast_if_small
from orderloom.plans import reports, rollup
from orderloom.samples.queries import QUERIES
from orderloom.schemas import ORDERS
from orderloom.session import shared_folder
from orderloom.sinks.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"
WRITING = {"daily_summary_upsert", "master_load", "stream_ingest", "stream_rejects", "stream_rejects_folded", "batch_metrics",
           "stream_replay", "hourly_job"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairwise_joins_windows_or_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python", "Pandas"):
        assert word not in text


def test_time_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["daily_revenue_trend"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate,2001-07-18T00:00)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    hours = plan(QUERIES["hourly_orders"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in hours and "LessThan(ts,2024-01-31T00:00)" in hours


def test_top_rows_need_no_full_sort(spark):
    for name in ("top_products", "recent_orders"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_orphans_read_the_orders_once(spark):
    text = plan(QUERIES["orphan_orders"](spark, SF_DIR))
    assert len(re.findall(r"Location: \S+ \[\S*lineitem", text)) == 1


def test_first_copies_by_one_number_need_no_sort(spark):
    rows = spark.range(10).select(F.col("id").alias("arrival"), (F.col("id") % 3).cast("string").alias("key"))
    assert "SortAggregate" not in plan(tag_first(rows, ["key"], ["arrival"]))


@pytest.fixture
def store(spark):
    """A warehouse with one order on each of two days."""
    store = Warehouse(spark, shared_folder(spark, "t")).create()
    orders = spark.sql("select 'o1' as order_id, timestamp_ntz '2024-05-31 09:00:00' as order_timestamp union all "
                       "select 'o2', timestamp_ntz '2024-04-30 09:00:00'")
    missing = {name: F.lit(None).cast(kind) for name, kind in ORDERS.items() if name not in orders.columns}
    store.append("orders", orders.withColumns(missing).withColumn("order_date", F.to_date("order_timestamp")))
    return store


def test_stored_orders_are_pruned_by_date(store):
    text = plan(reports.revenue_by_category(store.read("orders"), "2024-05-31 12:00:00"))
    assert re.search(r"PartitionFilters: \[.*order_date#\d+ >= 2024-05-01", text)
    day = plan(reports.hourly_orders(store.read("orders"), "2024-05-31"))
    assert re.search(r"PartitionFilters: \[.*order_date#\d+ = 2024-05-31", day)


def test_recent_orders_read_recent_days(store):
    text = plan(reports.recent_orders(store.read("orders"), 1, "2024-06-01 00:00:00"))
    assert re.search(r"PartitionFilters: \[.*order_date#\d+ >= 2024-05-25", text)


def test_recent_orders_read_the_newest_days_that_are_enough(spark, tmp_path):
    """No job runs before the result is asked for, and days that aren't needed are not opened: they hold no Parquet."""
    path = str(tmp_path / "orders")
    (spark.sql("""
        select concat('o', id) as order_id, timestamp_ntz '2024-05-01 08:00:00' + make_interval(0, 0, 0, int(id div 2)) as order_timestamp,
          'Pune' as customer_city, 'Books' as category, cast(id as decimal(12,2)) as final_amount, 'UPI' as payment_method,
          'Placed' as order_status, date '2024-05-01' + int(id div 2) as order_date from range(12)""")
     .write.partitionBy("order_date").parquet(path))
    (tmp_path / "orders" / "order_date=2024-04-01").mkdir()
    (tmp_path / "orders" / "order_date=2024-04-01" / "part-0.parquet").write_text("not a file of rows")
    orders = spark.read.schema("order_id string, order_timestamp timestamp_ntz, customer_city string, category string, "
                               "final_amount decimal(12,2), payment_method string, order_status string, order_date date").parquet(path)
    found = reports.recent_orders(orders, 3, "2024-05-06 12:00:00", 4)
    assert re.search(r"PartitionFilters: \[.*order_date#\d+ >= (scalar-)?[sS]ubquery", plan(found))
    assert [r[0] for r in found.collect()] == ["o10", "o11", "o8"]
    with pytest.raises(Exception, match="part-0"):
        reports.recent_orders(orders, 11, "2024-05-06 12:00:00", 4).collect()


def test_a_rollup_reads_only_the_days_it_recomputes(spark, store):
    dates = spark.sql("select date '2024-04-30' as order_date")
    text = plan(rollup.daily_summary(on_dates(store.read("orders"), dates)))
    assert re.search(r"PartitionFilters: \[.*order_date#\d+ = 2024-04-30", text)


def test_existing_keys_are_read_in_place(spark, store):
    """A small batch is broadcast against the stored keys: one column is read and nothing is shuffled."""
    batch = spark.createDataFrame([("o1",)], "order_id string")
    text = plan(held_keys(batch, store.read("orders"), ["order_id"]))
    assert "ReadSchema: struct<order_id:string>" in text
    assert "BroadcastHashJoin LeftSemi BuildRight" in text
    beyond = broadcast_if_small(batch, limit=10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in beyond


def test_distinct_customers_are_spread_before_they_are_counted(store):
    """The first exchange is on group and customer, so a large group is not one task's work."""
    text = plan(rollup.daily_summary(store.read("orders")))
    assert re.search(r"hashpartitioning\(\w+#\d+, category#\d+, customer_region#\d+, customer_id#\d+, \d+\)", text)
