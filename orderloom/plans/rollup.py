"""The daily summary: its computation, its idempotent load and its check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.calendar import Day, Instant, calendar_day, instant, on_day
from orderloom.operators.dates import on_dates
from orderloom.schemas import DAILY_SUMMARY, MONEY, SUMMARY_MEASURES

# Payment methods counted apart.
UPI = ("UPI",)
CARDS = ("Credit Card", "Debit Card")
CASH = ("Cash on Delivery",)


def summary_keys() -> tuple[Column, ...]:
    """Day, category and customer region of an order."""
    return F.to_date("order_timestamp").alias("summary_date"), F.col("category"), F.col("customer_region").alias("region")


def summary_measures(upi: Sequence[str] = UPI, cards: Sequence[str] = CARDS,
                     cash: Sequence[str] = CASH) -> dict[str, Column]:
    """The thirteen measures by name."""
    status, payment = F.col("order_status"), F.col("payment_method")
    return {
        "total_orders": F.count("*"),
        "total_revenue": F.sum("final_amount"),
        "total_tax": F.sum("tax_amount"),
        "avg_order_value": F.round(F.avg("final_amount"), 2),
        "total_quantity": F.sum("quantity"),
        "unique_customers": F.count_distinct("customer_id"),
        "new_customers": F.count_if("is_first_order"),
        "delivered_count": F.count_if(status == "Delivered"),
        "cancelled_count": F.count_if(status == "Cancelled"),
        "returned_count": F.count_if(status == "Returned"),
        "upi_count": F.count_if(payment.isin(*upi)),
        "card_count": F.count_if(payment.isin(*cards)),
        "cod_count": F.count_if(payment.isin(*cash)),
    }


def daily_summary(orders: DataFrame, upi: Sequence[str] = UPI, cards: Sequence[str] = CARDS,
                  cash: Sequence[str] = CASH) -> DataFrame:
    """Thirteen measures per day, category and customer region of the given orders, whatever their status.

    Counting distinct customers makes Spark shuffle on the group *and* the customer first, so that one large
    group is still spread over many tasks."""
    return orders.groupBy(*summary_keys()).agg(
        *(measure.cast(SUMMARY_MEASURES[name]).alias(name)
          for name, measure in summary_measures(upi, cards, cash).items()))


def last_batch(touched: DataFrame) -> int:
    """The number of the last batch that noted its dates; 0 before the first."""
    return touched.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("seq")).first()["seq"]


def upsert_daily_summary(orders: DataFrame, path: str, dates: DataFrame | None = None, day: Day = None,
                         computed_at: Instant = None, through: int = 0, **vocabulary: Sequence[str]) -> None:
    """Recompute whole days and replace their partitions; all other days stay as they are.

    ``dates`` lists the days to recompute, else it is the single ``day`` (today by default). ``through`` is the
    :func:`last_batch` from before the orders were read; it is written with the summary, in one commit. Running it again
    gives the same table. Orders are never removed, so no group can vanish from a recomputed day."""
    if dates is None:
        chosen = orders.filter(on_day(orders, day))
    else:
        dated = orders if "order_date" in orders.columns else orders.withColumn(
            "order_date", F.to_date("order_timestamp"))
        chosen = on_dates(dated, dates)
    write_summary(daily_summary(chosen, **vocabulary), path, computed_at, through)


def write_summary(summary: DataFrame, path: str, computed_at: Instant, through: int) -> None:
    """Make ``summary`` all that its days hold."""
    (summary.withColumn("computed_at", instant(computed_at)).withColumn("through_seq", F.lit(through).cast("bigint"))
     .select(*DAILY_SUMMARY)
     .hint("rebalance", "summary_date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("summary_date").parquet(path))


def stale_dates(touched: DataFrame, summary: DataFrame) -> DataFrame:
    """Days that got orders from a batch which their summary may lack, late arrivals included. Batches are numbered, so
    no two machines' clocks are compared: a batch takes its number after its orders are stored, a rollup the last number
    before it reads the orders."""
    news = touched.groupBy("order_date").agg(F.max("seq").alias("seq"))
    done = (summary.groupBy(F.col("summary_date").alias("done_date"))
            .agg(F.min("through_seq").alias("through")))
    pending = F.col("through").isNull() | (F.col("through") < F.col("seq"))
    return (news.join(done, F.col("order_date") == F.col("done_date"), "left")
            .filter(pending).select("order_date"))


def summary_check(summary: DataFrame, day: Day = None) -> DataFrame:
    """Rows, orders and revenue the summary holds for a day; zeros when it holds none."""
    return summary.filter(F.col("summary_date") == calendar_day(day)).agg(
        F.count("*").alias("categories"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("total_revenue"), F.lit(0).cast(MONEY)).alias("total_revenue"))
