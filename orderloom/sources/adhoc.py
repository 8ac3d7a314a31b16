"""Ad-hoc SQL with named parameters over DataFrames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession


def fetch(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """Rows of a query. ``:name`` marks a parameter, ``{name}`` a table given by keyword."""
    return spark.sql(sql, args=args, **tables)


def fetch_one(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, **tables: DataFrame) -> Row | None:
    """First row of a query, or None."""
    return fetch(spark, sql, args, **tables).first()
