"""Insert-if-absent as a join: rows whose key a table does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom.operators.sized import broadcast_if_small


def absent_rows(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` (unique by key) that ``stored`` lacks. For two sides of similar size."""
    return incoming.join(stored.select(*keys), keys, "left_anti")


def held_keys(incoming: DataFrame, stored: DataFrame, keys: list[str], *extra: str) -> DataFrame:
    """The part of ``stored`` whose keys occur in ``incoming``: the key columns and ``extra``.

    For a small, persisted batch against a huge table: within a measured size the batch's keys are broadcast, so
    that the table's key column is read in place and not shuffled. No more rows come out than the batch has."""
    wanted = broadcast_if_small(incoming.select(*keys))
    return stored.select(*keys, *extra).join(wanted, keys, "left_semi")
