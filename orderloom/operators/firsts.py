"""First-copy-wins selection that stays even when one key holds much of the data.

``row_number`` over the key would bring all copies of a key to one task. Here the earliest arrival per key is an
aggregate, combined on the map side, and rows are matched to it on key *and* arrival, so that the copies of one
key spread over all tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_STAMP = "_first_arrival"


def tag_first(df: DataFrame, keys: list[str], arrival: list[str], flag: str = "is_first",
              among: Column | None = None) -> DataFrame:
    """Add ``flag``: is this row the earliest copy of its key?

    ``arrival`` columns together must tell all copies of a key apart (a Kafka partition and offset, a file and a
    position) and are never NULL; a single number is the cheapest, as its minimum is a hash aggregate. NULL keys count
    as one key. Rows outside ``among`` neither compete nor get the flag."""
    stamp = F.col(arrival[0]) if len(arrival) == 1 else F.struct(*arrival)
    names = {key: f"_key_{key}" for key in keys}
    candidates = df if among is None else df.filter(among)
    firsts = (candidates
              .groupBy(*(F.col(key).alias(name) for key, name in names.items()))
              .agg(F.min(stamp).alias(_STAMP)))
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]
    if among is not None:
        same.append(among)
    matched = df.join(firsts, reduce(Column.__and__, same, stamp == F.col(_STAMP)), "left")
    return matched.withColumn(flag, F.col(_STAMP).isNotNull()).drop(_STAMP, *names.values())


def later_copies(df: DataFrame, keys: list[str], arrival: str, among: Column, row: str) -> DataFrame:
    """``row``, which tells rows apart, of all but the earliest copy of each key, among the rows that meet ``among``. Only
    these columns are looked at, so a wide table is told its copies without being shuffled: see :func:`tag_listed`."""
    narrow = df.filter(among).select(*keys, arrival, row)
    return tag_first(narrow, keys, [arrival], "_first").filter(~F.col("_first")).select(row)


def tag_listed(df: DataFrame, listed: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag``: does ``listed``, whose only column is ``key`` and has no value twice, have the row's?"""
    marks = listed.select(F.col(key).alias(f"_in_{key}"))
    return df.join(marks, F.col(key) == F.col(f"_in_{key}"), "left").withColumn(
        flag, F.col(f"_in_{key}").isNotNull()).drop(f"_in_{key}")


def keep_first(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """Only the earliest copy of each key: one shuffle, at most one row per key and task in it."""
    rest = [name for name in df.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*arrival)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break uniqueness, with their number of copies."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
