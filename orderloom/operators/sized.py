"""Broadcasting by measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Per task this much of the other side is spared a shuffle; a driver and an executor hold it easily.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BYTES = 32


def broadcast_if_small(rows: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``rows``, marked for broadcast when their measured size is within ``limit``, else as they are, to be
    shuffled. Runs a job: for narrow tables that are persisted or cheap to compute."""
    lengths = (F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in rows.columns)
    width = reduce(Column.__add__, lengths, F.lit(_ROW_BYTES)).cast("bigint")
    size = rows.agg(F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()["size"]
    return F.broadcast(rows) if size <= limit else rows
