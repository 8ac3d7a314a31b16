"""Restricting a date-partitioned table to the dates another one has."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F


def listed_dates(rows: DataFrame) -> list[dt.date]:
    """The distinct ``order_date`` values of ``rows``, null apart. There are as many as days in the calendar at most,
    however many rows there are."""
    found = rows.select("order_date").distinct().collect()
    return sorted(row["order_date"] for row in found if row["order_date"] is not None)


def on_dates(table: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``order_date`` occurs in ``dates``. The dates become literals, so that all other
    partitions are left out when the query is planned."""
    return table.filter(F.col("order_date").isin(listed_dates(dates)))
