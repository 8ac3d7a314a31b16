"""Data-quality checks over the stored orders: one row per check, and a gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.calendar import Instant, instant, on_day, within_day

# Thresholds of the checks.
MAX_CANCELLATION_RATE = 40.0
FUTURE_TOLERANCE = dt.timedelta(days=1)

Check = tuple[Column, float]


class QualityError(Exception):
    """At least one check failed; the message lists all that did."""


def run_dq(orders: DataFrame, as_of: Instant = None, changed: DataFrame | None = None) -> DataFrame:
    """``(check, observed, threshold, passed)`` for five checks.

    The first three and the last cover the whole table, the cancellation rate the day of ``as_of``; all five
    come from a single aggregate. With ``changed``, the orders loaded since the checks passed last, the first
    three look at those only: stored orders never change, so older ones would pass again. The rate then reads
    one day and the last check no column at all."""
    now = instant(as_of)
    row_checks, day_checks, table_checks = _row_checks(now), _day_checks(now), _table_checks()
    if changed is None:
        return _report(orders, row_checks | day_checks | table_checks)
    return (_report(changed, row_checks)
            .unionByName(_report(orders.filter(on_day(orders, now.cast("date"))), day_checks))
            .unionByName(_report(orders, table_checks)))


def _row_checks(now: Column) -> dict[str, Check]:
    future = F.col("order_timestamp") > now + F.lit(FUTURE_TOLERANCE)
    return {
        "null_order_ids": (F.count_if(F.col("order_id").isNull()), 0.0),
        "negative_amounts": (F.count_if(F.col("final_amount") < 0), 0.0),
        "future_orders": (F.count_if(future), 0.0),
    }


def _day_checks(now: Column) -> dict[str, Check]:
    today = within_day(F.col("order_timestamp"), now.cast("date"))
    cancelled = F.count_if(today & (F.col("order_status") == "Cancelled")).cast("decimal(20,0)")
    rate = F.round(F.try_divide(cancelled * 100, F.count_if(today)), 2)
    return {"cancellation_rate": (F.coalesce(rate.cast("double"), F.lit(0.0)), MAX_CANCELLATION_RATE)}


def _table_checks() -> dict[str, Check]:
    return {"table_not_empty": (F.count("*"), 1.0)}


def _report(rows: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """One row per check. The last check wants its threshold reached, all others not exceeded."""
    figures = rows.agg(*(figure.cast("double").alias(name) for name, (figure, _) in checks.items()))
    lines = F.array(*(F.struct(F.lit(name).alias("check"), F.col(name).alias("observed"),
                               F.lit(limit).alias("threshold")) for name, (_, limit) in checks.items()))
    observed, threshold = F.col("observed"), F.col("threshold")
    passed = F.when(F.col("check") == "table_not_empty", observed >= threshold).otherwise(observed <= threshold)
    return figures.select(F.inline(lines)).withColumn("passed", passed)


def assert_dq(orders: DataFrame, as_of: Instant = None, changed: DataFrame | None = None) -> None:
    """Raise :class:`QualityError` naming every failed check."""
    failed = run_dq(orders, as_of, changed).filter("not passed").collect()
    if failed:
        raise QualityError("; ".join(
            f"{row['check']}: observed {row['observed']:g}, threshold {row['threshold']:g}" for row in failed))
