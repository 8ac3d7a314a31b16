"""The index of stored order ids: which batch brought an order, found without reading the orders.

Ids lie in ``KEY_BUCKETS`` folders by hash, so a batch reads the buckets that its own ids fall in and no others. Ids of a
small batch go to one more folder first, as one file, which every search reads too; :func:`fold_keys` deals them out once
there are many such files. The index only ever gains ids of orders that are stored; an id that is there twice does no
harm, so each step can be repeated.

Orders are written before their ids. Before either, the batch notes the dates it writes to (``open_batches``), and drops
the note when both are done. Whoever comes next, the same batch again or another job, takes up what notes are left: the
ids of the orders that such a batch did store are added from those dates alone."""

from __future__ import annotations

import datetime as dt
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from orderloom import schemas

if TYPE_CHECKING:
    from orderloom.sinks.warehouse import Warehouse

# Fixed for the life of a warehouse: ids are found by it.
KEY_BUCKETS = 256
FRESH = -1
# Ids per bucket from which a batch writes to the buckets itself, and fresh files that are left lying.
DIRECT, FRESH_FILES = 1000, 48


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def indexed(warehouse: Warehouse, rows: DataFrame) -> DataFrame:
    """(order_id, ingest_batch, bucket) of the part of the index in which ids of ``rows`` would be found. Collects the
    bucket numbers, ``KEY_BUCKETS`` at most."""
    buckets = sorted(r["bucket"] for r in rows.select(bucket_of(F.col("order_id")).alias("bucket")).distinct().collect())
    return warehouse.read_partitions("order_keys", [FRESH, *buckets])


def add_keys(warehouse: Warehouse, orders: DataFrame, label: str, number: int) -> None:
    """Note that batch ``label`` stored ``orders``, ``number`` of them."""
    rows = orders.select("order_id", F.lit(label).alias("ingest_batch"))
    if number >= DIRECT * KEY_BUCKETS:
        warehouse.append("order_keys", rows.withColumn("bucket", bucket_of(F.col("order_id"))))
    elif number:
        warehouse.append("order_keys", rows.withColumn("bucket", F.lit(FRESH)).coalesce(1))


def open_batch(warehouse: Warehouse, label: str, dates: list[dt.date]) -> None:
    rows = warehouse.spark.createDataFrame([(day, label) for day in dates], schemas.ddl(schemas.OPEN_BATCHES))
    warehouse.replace_partition("open_batches", label, rows.coalesce(1))


def close_batch(warehouse: Warehouse, label: str) -> None:
    warehouse.drop_partition("open_batches", label)


def recover(warehouse: Warehouse) -> None:
    """Index what unfinished batches stored. There is one such batch at most where one job writes at a time."""
    dates: dict[str, list[dt.date]] = {}
    for row in warehouse.read("open_batches").collect():
        dates.setdefault(row["ingest_batch"], []).append(row["order_date"])
    for label, days in dates.items():
        stored = warehouse.read_partitions("orders", sorted(days)).filter(F.col("ingest_batch") == label)
        add_keys(warehouse, stored, label, stored.count())
        close_batch(warehouse, label)


def fold_keys(warehouse: Warehouse, files: int = FRESH_FILES) -> bool:
    """Deal the fresh ids out to their buckets if they lie in more than ``files`` files. The files are dropped after
    the ids were written, so a fold that is cut off leaves some ids in two places."""
    fresh = warehouse.files("order_keys", FRESH)
    if len(fresh) <= files:
        return False
    layout = {name: kind for name, kind in schemas.ORDER_KEYS.items() if name != "bucket"}
    rows = warehouse.spark.read.schema(schemas.ddl(layout)).parquet(*fresh)
    warehouse.append("order_keys", rows.withColumn("bucket", bucket_of(F.col("order_id"))))
    warehouse.drop_files(fresh)
    return True


def build_keys(warehouse: Warehouse) -> None:
    """The index of a warehouse that has none yet: one pass over the ids of all orders. It appears under its name when
    it is whole."""
    rows = warehouse.read("orders").select("order_id", "ingest_batch", bucket_of(F.col("order_id")).alias("bucket"))
    building = f"{warehouse.path('order_keys')}_building"
    (rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(building))
    warehouse.rename(building, warehouse.path("order_keys"))
