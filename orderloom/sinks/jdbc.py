"""Bulk load into a relational database over JDBC. The driver must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: rows per insert statement.
BATCH_ROWS = 100


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                batch_rows: int = BATCH_ROWS) -> None:
    """Append ``rows``; each task sends its part in one transaction of multi-row statements.

    JDBC append cannot skip existing keys: pass rows that went through ``absent_rows`` first."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **(properties or {})}
    rows.write.format("jdbc").options(**options).mode("append").save()
