"""Time predicates over ``timestamp_ntz`` columns, written as ranges so that they reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

Instant = dt.datetime | str | Column | None
Day = dt.date | str | Column | None


def instant(as_of: Instant = None) -> Column:
    """``as_of`` as a zone-less timestamp; now when not given."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    text = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of
    return F.lit(text).cast("timestamp_ntz")


def calendar_day(day: Day = None) -> Column:
    """``day`` as a date; today when not given."""
    if day is None:
        return F.current_date()
    return (day if isinstance(day, Column) else F.lit(str(day))).cast("date")


def trailing_days(orders: DataFrame, as_of: Instant, days: int) -> Column:
    """Orders of the ``days`` days before ``as_of``. There is no upper bound."""
    start = instant(as_of) - F.lit(dt.timedelta(days=days))
    return _with_partitions(orders, F.col("order_timestamp") >= start, lambda date: date >= start.cast("date"))


def on_day(orders: DataFrame, day: Day, column: str = "order_timestamp") -> Column:
    """Rows of one calendar day."""
    start = calendar_day(day)
    return _with_partitions(orders, within_day(F.col(column), start), lambda date: date == start)


def within_day(moment: Column, day: Column) -> Column:
    return (moment >= day.cast("timestamp_ntz")) & (moment < F.date_add(day, 1).cast("timestamp_ntz"))


def _with_partitions(orders: DataFrame, condition: Column, on_date) -> Column:
    """Repeat a time condition on the partition column where the table has one, so that whole
    partitions drop out before any file is opened."""
    return condition & on_date(F.col("order_date")) if "order_date" in orders.columns else condition
