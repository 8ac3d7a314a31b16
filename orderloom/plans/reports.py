"""The dashboard's queries over the stored orders.

Every function takes the orders table (and the moment or day it reports on) and returns a lazy DataFrame. Sort
directions name the place of NULLs, which Spark puts on the other end by default, and end in a tie-break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions import display
from orderloom.functions.calendar import Day, Instant, instant, on_day, trailing_days
from orderloom.schemas import MONEY, NON_REVENUE_STATUSES


def is_revenue() -> Column:
    """Orders that count as sales. A NULL status does not."""
    return ~F.col("order_status").isin(*NON_REVENUE_STATUSES)


def _mean_amount() -> Column:
    return F.round(F.avg("final_amount"), 2).cast(MONEY).alias("avg_order_value")


def kpi_totals(orders: DataFrame) -> DataFrame:
    """One row of key figures, also for an empty table."""
    revenue = F.coalesce(F.sum("final_amount"), F.lit(0).cast(MONEY))
    mean = F.coalesce(F.try_divide(F.sum("final_amount").cast("double"), F.count("final_amount")), F.lit(0.0))
    return orders.filter(is_revenue()).agg(
        F.count("*").alias("total_orders"), revenue.alias("total_revenue"), mean.alias("avg_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"))


def revenue_by_category(orders: DataFrame, as_of: Instant = None) -> DataFrame:
    """Sales of the last 30 days per category."""
    return (orders.filter(trailing_days(orders, as_of, 30) & is_revenue())
            .groupBy("category")
            .agg(F.count("*").alias("total_orders"), F.sum("final_amount").alias("total_revenue"),
                 _mean_amount(), F.sum("quantity").alias("total_items_sold"))
            .orderBy(F.desc_nulls_first("total_revenue"), "category"))


def revenue_by_region(orders: DataFrame, as_of: Instant = None) -> DataFrame:
    """Orders of the last 30 days per customer region, cancelled and returned ones included."""
    return (orders.filter(trailing_days(orders, as_of, 30))
            .groupBy(F.col("customer_region").alias("region"))
            .agg(F.count("*").alias("total_orders"), F.sum("final_amount").alias("total_revenue"),
                 F.count_distinct("customer_id").alias("unique_customers"))
            .orderBy(F.desc_nulls_first("total_revenue"), "region"))


def daily_revenue_trend(orders: DataFrame, as_of: Instant = None) -> DataFrame:
    """Orders of the last 14 days per calendar day; the first day is cut off at the time of ``as_of``."""
    return (orders.filter(trailing_days(orders, as_of, 14))
            .groupBy(F.to_date("order_timestamp").alias("order_date"))
            .agg(F.count("*").alias("total_orders"), F.sum("final_amount").alias("daily_revenue"), _mean_amount())
            .orderBy(F.asc_nulls_last("order_date")))


def top_products(orders: DataFrame, limit: int = 10) -> DataFrame:
    """Best-selling products by revenue, all time."""
    return (orders.filter(is_revenue())
            .groupBy("product_name", "category", "brand")
            .agg(F.count("*").alias("times_ordered"), F.sum("quantity").alias("total_qty_sold"),
                 F.sum("final_amount").alias("total_revenue"))
            .orderBy(F.desc_nulls_first("total_revenue"), "product_name", "category", "brand")
            .limit(limit))


def payment_distribution(orders: DataFrame) -> DataFrame:
    """Orders and their share in percent per payment method.

    The total is a scalar subquery over the grouped counts, which reuses their shuffle; a window without
    partitions would bring all groups to one task."""
    counts = orders.groupBy("payment_method").agg(F.count("*").alias("order_count"))
    total = counts.agg(F.sum("order_count")).scalar()
    share = F.col("order_count").cast("decimal(20,0)") * 100 / total
    return (counts.withColumn("percentage", F.round(share, 2).cast("decimal(5,2)"))
            .orderBy(F.desc_nulls_first("order_count"), "payment_method"))


def hourly_orders(orders: DataFrame, day: Day = None) -> DataFrame:
    """Orders and revenue per hour of one day; hours without orders are absent."""
    return (orders.filter(on_day(orders, day))
            .groupBy(F.hour("order_timestamp").alias("hour"))
            .agg(F.count("*").alias("order_count"), F.sum("final_amount").alias("revenue"))
            .orderBy(F.asc_nulls_last("hour")))


RECENT_COLUMNS = ("order_id", "order_timestamp", "customer_city", "category",
                  "final_amount", "payment_method", "order_status")


def _reaching(dates: Column, limit: int) -> Column:
    """The date down to which (order_date, n) have ``limit`` rows, counted from the newest; null if they have fewer.
    There is one entry per day."""
    start = F.struct(F.lit(None).cast("date").alias("order_date"), F.lit(0).cast("bigint").alias("n"))
    walked = F.aggregate(F.sort_array(dates, asc=False), start, lambda done, day: F.when(done["n"] >= limit, done).otherwise(
        F.struct(day["order_date"].alias("order_date"), (done["n"] + day["n"]).alias("n"))))
    return F.when(walked["n"] >= limit, walked["order_date"])


def recent_orders(orders: DataFrame, limit: int = 20, as_of: Instant = None, days: int = 7) -> DataFrame:
    """The latest orders. Order ids are unique in a stored table; further ties can only be among copies.

    In a table partitioned by date, the newest partitions that together hold ``limit`` orders are enough, and that of
    orders without a time, which come first. They are found within the query, from the row counts of the partitions since
    ``days`` before ``as_of``; where those hold fewer, the whole table is read, to the same answer."""
    if "order_date" in orders.columns:
        since = orders.filter(F.col("order_date") >= F.date_sub(instant(as_of).cast("date"), days))
        oldest = since.groupBy("order_date").agg(F.count("*").alias("n")).agg(
            _reaching(F.collect_list(F.struct("order_date", "n")), int(limit))).scalar()
        orders = orders.filter(F.coalesce(F.col("order_date") >= oldest, F.lit(True)))
    return (orders.select(*RECENT_COLUMNS)
            .orderBy(F.desc_nulls_first("order_timestamp"), "order_id", "final_amount", "category")
            .limit(int(limit)))


def recent_orders_display(orders: DataFrame, limit: int = 15, as_of: Instant = None) -> DataFrame:
    """The live feed: latest orders with shortened ids, formatted amounts and times, and display headings."""
    shown = recent_orders(orders, limit, as_of)
    return (shown.withColumns({
        "order_id": display.short_id(F.col("order_id")),
        "final_amount": display.format_amount(F.col("final_amount")),
        "order_timestamp": display.format_time(F.col("order_timestamp")),
    }).withColumnsRenamed({
        "order_id": "Order ID", "order_timestamp": "Time", "customer_city": "City", "category": "Category",
        "final_amount": "Amount", "payment_method": "Payment", "order_status": "Status",
    }))


def payment_display(orders: DataFrame) -> DataFrame:
    """The payment table under its display headings."""
    return payment_distribution(orders).withColumnsRenamed(
        {"payment_method": "Method", "order_count": "Orders", "percentage": "Share %"})


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("row_count"))
