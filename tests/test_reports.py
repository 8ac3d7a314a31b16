import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.plans import quality, reports, rollup
from orderloom.schemas import ORDERS, ddl
from orderloom.session import shared_folder
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources.adhoc import fetch, fetch_one

AS_OF = "2024-05-31 12:00:00"
BASE = {
    "order_id": "o", "order_timestamp": dt.datetime(2024, 5, 31, 9, 30), "customer_id": "c1", "category": "Books",
    "customer_region": "West", "customer_city": "Pune", "product_name": "Lamp", "brand": "Acme", "quantity": 1,
    "tax_amount": Decimal("1.00"), "final_amount": Decimal("10.00"), "payment_method": "UPI",
    "order_status": "Placed", "is_first_order": False,
}


def orders_of(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**BASE, "order_id": f"o{i:03d}", **change}
        row["order_date"] = row["order_timestamp"].date()
        rows.append(tuple(row.get(name) for name in ORDERS))
    return spark.createDataFrame(rows, ddl(ORDERS))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_kpis_leave_out_cancelled_and_null_status(spark):
    orders = orders_of(spark, {}, {"final_amount": Decimal("5.01"), "customer_id": "c2"},
                       {"order_status": "Cancelled"}, {"order_status": "Returned"}, {"order_status": None},
                       {"order_status": "None", "customer_id": None})
    assert rows(reports.kpi_totals(orders)) == [(3, Decimal("25.01"), 25.01 / 3, 2)]
    assert rows(reports.kpi_totals(orders.limit(0))) == [(0, Decimal("0.00"), 0.0, 0)]


def test_categories_of_thirty_days(spark):
    orders = orders_of(
        spark, {"quantity": 3}, {"final_amount": Decimal("10.01")}, {"category": "Toys", "quantity": 7},
        {"order_timestamp": dt.datetime(2024, 5, 1, 12)}, {"order_timestamp": dt.datetime(2024, 5, 1, 11, 59, 59)},
        {"order_status": "Returned"})
    assert rows(reports.revenue_by_category(orders, AS_OF)) == [
        ("Books", 3, Decimal("30.01"), Decimal("10.00"), 5), ("Toys", 1, Decimal("10.00"), Decimal("10.00"), 7)]


def test_regions_count_every_status(spark):
    orders = orders_of(spark, {"order_status": "Cancelled"}, {}, {"customer_region": None, "customer_id": "c3"},
                       {"order_timestamp": dt.datetime(2024, 6, 30)})
    assert rows(reports.revenue_by_region(orders, AS_OF)) == [
        ("West", 3, Decimal("30.00"), 1), (None, 1, Decimal("10.00"), 1)]


def test_trend_starts_within_a_day(spark):
    first = dt.datetime(2024, 5, 17, 12)
    orders = orders_of(spark, {"order_timestamp": first}, {"order_timestamp": first - dt.timedelta(seconds=1)}, {})
    assert [r[:2] for r in rows(reports.daily_revenue_trend(orders, AS_OF))] == [
        (dt.date(2024, 5, 17), 1), (dt.date(2024, 5, 31), 1)]


def test_top_products_by_name(spark):
    changes = [{"product_name": f"p{i:02d}", "final_amount": Decimal(i)} for i in range(1, 13)]
    got = rows(reports.top_products(orders_of(spark, *changes, {"product_name": "p05", "product_id": "other"})))
    assert len(got) == 10
    assert [r[0] for r in got[:2]] == ["p05", "p12"] and got[0][3] == 2


def test_payment_shares(spark):
    orders = orders_of(spark, {}, {}, {"payment_method": None})
    got = reports.payment_distribution(orders)
    assert rows(got) == [("UPI", 2, Decimal("66.67")), (None, 1, Decimal("33.33"))]
    assert reports.payment_display(orders).columns == ["Method", "Orders", "Share %"]


def test_hours_of_a_day(spark):
    midnight = dt.datetime(2024, 5, 31)
    orders = orders_of(spark, {"order_timestamp": midnight}, {}, {}, {"order_timestamp": midnight + dt.timedelta(1)})
    assert rows(reports.hourly_orders(orders, "2024-05-31")) == [(0, 1, Decimal("10.00")), (9, 2, Decimal("20.00"))]


def test_recent_orders(spark):
    orders = orders_of(spark, *({"order_timestamp": dt.datetime(2024, 5, 1, i)} for i in range(24)))
    assert [r[0] for r in rows(reports.recent_orders(orders, 3))] == ["o023", "o022", "o021"]
    for as_of in (AS_OF, "2024-05-03 00:00:00", "2030-01-01 00:00:00"):
        assert [r[0] for r in rows(reports.recent_orders(orders, 30, as_of))] == [f"o{i:03d}" for i in range(23, -1, -1)]
        assert [r[0] for r in rows(reports.recent_orders(orders, 3, as_of))] == ["o023", "o022", "o021"]
    shown = reports.recent_orders_display(orders.withColumn("order_id", F.lit("123456789")), 1).first()
    assert shown.asDict() == {"Order ID": "12345678...", "Time": "01 May 23:00", "City": "Pune", "Category": "Books",
                              "Amount": "₹10.00", "Payment": "UPI", "Status": "Placed"}


def test_adhoc_queries(spark):
    orders = orders_of(spark, {}, {"category": "Toys"})
    sql = "select category from {orders} where category = :category"
    assert rows(fetch(spark, sql, {"category": "Toys"}, orders=orders)) == [("Toys",)]
    assert fetch_one(spark, sql, {"category": "Sports"}, orders=orders) is None
    assert reports.row_count(orders).first()["row_count"] == 2


def failed(report):
    return {r["check"]: r["observed"] for r in report.collect() if not r["passed"]}


def test_quality_checks(spark):
    good = orders_of(spark, {}, {"order_status": "Cancelled"}, {}, {}, {})
    assert failed(quality.run_dq(good, AS_OF)) == {}
    quality.assert_dq(good, AS_OF)
    bad = orders_of(spark, {"order_id": None}, {"final_amount": Decimal("-1")}, {"order_status": "Cancelled"},
                    {"order_timestamp": dt.datetime(2024, 6, 1, 12, 0, 1)}, {"order_status": "Cancelled"})
    assert failed(quality.run_dq(bad, AS_OF)) == {
        "null_order_ids": 1.0, "negative_amounts": 1.0, "future_orders": 1.0, "cancellation_rate": 50.0}
    assert sorted(rows(quality.run_dq(bad, AS_OF, changed=bad))) == sorted(rows(quality.run_dq(bad, AS_OF)))
    assert failed(quality.run_dq(bad, AS_OF, changed=bad.limit(0))) == {"cancellation_rate": 50.0}
    with pytest.raises(quality.QualityError, match="null_order_ids.*cancellation_rate"):
        quality.assert_dq(bad, AS_OF)


def test_quality_of_an_empty_table_and_an_idle_day(spark):
    assert failed(quality.run_dq(orders_of(spark, {}).limit(0), AS_OF)) == {"table_not_empty": 0.0}
    idle = orders_of(spark, {"order_timestamp": dt.datetime(2024, 5, 1), "order_status": "Cancelled"})
    assert failed(quality.run_dq(idle, AS_OF)) == {}


def test_daily_summary_measures(spark):
    orders = orders_of(
        spark, {"order_status": "Delivered", "is_first_order": True},
        {"order_status": "Cancelled", "payment_method": "Credit Card"},
        {"order_status": "Returned", "payment_method": "Debit Card", "customer_id": "c2"},
        {"payment_method": "Cash on Delivery", "final_amount": Decimal("10.03"), "tax_amount": None})
    got = rollup.daily_summary(orders).first().asDict()
    assert got == {
        "summary_date": dt.date(2024, 5, 31), "category": "Books", "region": "West", "total_orders": 4,
        "total_revenue": Decimal("40.03"), "total_tax": Decimal("3.00"), "avg_order_value": Decimal("10.01"),
        "total_quantity": 4, "unique_customers": 2, "new_customers": 1, "delivered_count": 1, "cancelled_count": 1,
        "returned_count": 1, "upi_count": 1, "card_count": 2, "cod_count": 1}


def test_summary_load_replaces_one_day_only(spark):
    warehouse = Warehouse(spark, shared_folder(spark, "t")).create()
    path = warehouse.path("daily_summary")
    monday = {"order_timestamp": dt.datetime(2024, 5, 30, 8)}
    rollup.upsert_daily_summary(orders_of(spark, {}, monday), path, day="2024-05-30")
    rollup.upsert_daily_summary(orders_of(spark, {}, monday), path, day="2024-05-31")
    for _ in range(2):
        rollup.upsert_daily_summary(orders_of(spark, {}, {}, monday, monday), path, day="2024-05-31")
    summary = warehouse.read("daily_summary")
    assert {(r["summary_date"].day, r["total_orders"]) for r in summary.collect()} == {(30, 1), (31, 2)}
    assert rows(rollup.summary_check(summary, "2024-05-31")) == [(1, 2, Decimal("20.00"))]
    assert rows(rollup.summary_check(summary, "2024-06-01")) == [(0, 0, Decimal("0.00"))]


def test_stale_dates(spark):
    """Days whose last batch is later than the one their summary was made after; no clock is asked."""
    touched = spark.createDataFrame(
        [(dt.date(2024, 5, 1), 4), (dt.date(2024, 5, 1), 7), (dt.date(2024, 5, 2), 5), (dt.date(2024, 5, 3), 1)],
        "order_date date, seq bigint")
    summary = spark.createDataFrame(
        [(dt.date(2024, 5, 1), 6), (dt.date(2024, 5, 2), 5), (dt.date(2024, 5, 2), 5)], "summary_date date, through_seq bigint")
    assert {r[0].day for r in rollup.stale_dates(touched, summary).collect()} == {1, 3}
    assert rollup.last_batch(touched) == 7 and rollup.last_batch(touched.limit(0)) == 0

def test_recent_orders_without_a_time_come_first_whatever_the_window(spark):
    orders = spark.sql("""
        select * from values ('a', timestamp_ntz '2024-05-05 10:00:00', date '2024-05-05'), ('n', null, null)
        as t(order_id, order_timestamp, order_date)""").selectExpr(
        "*", "'x' as customer_city", "'Books' as category", "cast(1 as decimal(12,2)) as final_amount",
        "'UPI' as payment_method", "'Placed' as order_status")
    for as_of in ("2024-05-06 00:00:00", "2025-05-06 00:00:00"):
        for limit, expected in ((1, ["n"]), (2, ["n", "a"]), (9, ["n", "a"])):
            assert [r[0] for r in reports.recent_orders(orders, limit, as_of).collect()] == expected
