"""The hourly job: drain the stream, check the orders, roll up, verify."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.calendar import Instant, instant
from orderloom.operators.dates import on_dates
from orderloom.plans.merged import merge_daily_summary, pending_batches
from orderloom.plans.quality import assert_dq
from orderloom.plans.rollup import last_batch, stale_dates, summary_check, upsert_daily_summary
from orderloom.sinks.warehouse import Warehouse
from orderloom.streaming.ingest import DRAIN_SECONDS, IngestOptions, drain, utc_now


def run_hourly(messages: DataFrame, warehouse: Warehouse, checkpoint: str, as_of: Instant = None,
               options: IngestOptions = IngestOptions(), dates: str = "today",
               seconds: float | None = DRAIN_SECONDS, **vocabulary: Sequence[str]) -> DataFrame:
    """Run once and return one row of figures; ``drained`` is false when time ran out before the stream did, and the
    figures lack what is left. A failed quality check raises before the rollup.

    ``dates`` is ``today`` (the day of ``as_of`` only), ``stale`` (every day that got orders since its last
    summary, so that late orders are counted too) or ``merged`` (the same days, but only what they got is read and
    added). A day stays stale until it is rolled up, so the quality checks can be confined to stale days: orders that
    fail them are met again on the next run."""
    if dates not in ("today", "stale", "merged"):
        raise ValueError(f"dates must be 'today', 'stale' or 'merged', not {dates!r}")
    began = utc_now()
    drained = drain(messages, warehouse, checkpoint, options, seconds)
    through = last_batch(warehouse.read("touched_dates"))
    orders = warehouse.read("orders")
    chosen = None
    if dates == "stale":
        chosen = stale_dates(warehouse.read("touched_dates"), warehouse.read("daily_summary"))
    elif dates == "merged":
        chosen = pending_batches(warehouse).select("order_date")
    assert_dq(orders, as_of, on_dates(orders, chosen) if chosen is not None else None)
    today = instant(as_of).cast("date")
    if dates == "merged":
        merge_daily_summary(warehouse, utc_now(), **vocabulary)
    else:
        upsert_daily_summary(orders, warehouse.path("daily_summary"), chosen, today, utc_now(), through, **vocabulary)
    ingested = (warehouse.read("batch_metrics").filter(F.col("finished_at") >= instant(began))
                .agg(F.coalesce(F.sum("consumed"), F.lit(0)).alias("consumed"),
                     F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted")).first())
    return summary_check(warehouse.read("daily_summary"), today).select(
        F.lit(ingested["consumed"]).cast("bigint").alias("consumed"),
        F.lit(ingested["inserted"]).cast("bigint").alias("inserted"), F.lit(drained).alias("drained"),
        "categories", "total_orders", "total_revenue")
