"""Stream runs over order events derived from the given tables and landed as files."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.operators import constraints
from orderloom.plans.masters import load_master
from orderloom.samples import tables as given
from orderloom.schemas import EVENT_FIELDS
from orderloom.session import shared_folder
from orderloom.sinks.warehouse import Warehouse, insert_if_absent
from orderloom.sources.events import landed_orders
from orderloom.streaming.ingest import IngestOptions, drain

# Orders land in three waves by ship date, and every wave is drained before the next one lands.
WAVES = ("1995-01-01", "1997-07-01", "1999-07-01", "9999-01-01")
OPTIONS = IngestOptions(categories=given.CATEGORIES, fixed_dates=True)


# Orders of all months, and nothing promised about their dates.
OPEN = IngestOptions(categories=given.CATEGORIES)
BOUNDED = IngestOptions(categories=given.CATEGORIES, redelivery="30 days")


def as_messages(events: DataFrame) -> DataFrame:
    """Raw events as JSON text, some of it cut off, with the columns of ``ARRIVAL``."""
    value = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})
    cut = (F.col("l_linenumber") == 7) & (F.col("l_discount") == 0.01)
    return events.select(
        F.when(cut, F.substring(value, 1, 20)).otherwise(value).alias("value"), *given.ARRIVAL)


def event_messages(spark: SparkSession, sf_dir: str, when: Column | None = None) -> DataFrame:
    return as_messages(given.raw_events(spark, sf_dir, when))


def arriving_waves(spark: SparkSession, sf_dir: str, path: str, when: Column | None = None) -> Iterator[int]:
    """Land one wave after another, each in arrival order: the parts of a sorted write are named in order too.

    A wave is made of its own line items when its turn comes; its files are compressed."""
    for wave, (start, end) in enumerate(pairwise(WAVES)):
        messages = as_messages(given.arriving_events(spark, sf_dir, _shipped(start, end), when))
        messages.select("value").write.mode("append").option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")
        yield wave


def _shipped(start: str, end: str) -> Column:
    when = F.col("l_shipdate")
    return (when >= F.lit(start).cast("timestamp_ntz")) & (when < F.lit(end).cast("timestamp_ntz"))


def accepted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = constraints.tag_violations(given.customer_master(spark, sf_dir), constraints.customer_rules())
    return constraints.split(constraints.tag_repeated_emails(tagged, ["arrival"]))[0]


def accepted_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = constraints.tag_violations(given.product_master(spark, sf_dir), constraints.product_rules())
    return constraints.split(tagged)[0]


def accepted_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = constraints.tag_violations(given.store_master(spark, sf_dir), constraints.store_rules())
    return constraints.split(tagged)[0]


def load_masters(spark: SparkSession, sf_dir: str, warehouse: Warehouse) -> dict[str, int]:
    """Load the master data that meets its constraints; returns rows added per table."""
    masters = {"customers": (accepted_customers, "customer_id"), "products": (accepted_products, "product_id"),
               "stores": (accepted_stores, "store_id")}
    return {name: insert_if_absent(warehouse, name, rows(spark, sf_dir), key, ["arrival"])
            for name, (rows, key) in masters.items()}


def ingest_waves(spark: SparkSession, sf_dir: str, options: IngestOptions = OPTIONS,
                 when: Column | None = None) -> tuple[Warehouse, str]:
    """Land and drain all waves into a new warehouse. Returns it and the landing folder."""
    root = shared_folder(spark, "stream")
    warehouse, landing = Warehouse(spark, f"{root}/warehouse").create(), f"{root}/landing"
    load_masters(spark, sf_dir, warehouse)
    for _ in arriving_waves(spark, sf_dir, landing, when):
        drain(landed_orders(spark, landing, by_name=True), warehouse, f"{root}/checkpoint", options, seconds=None)
    return warehouse, landing


def dumped_topic(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a topic dumped as Parquet, with partition, offset and time of arrival."""
    rows = spark.readStream.schema("value string, partition int, offset bigint, arrived timestamp").parquet(path)
    return rows.select("value", F.struct("partition", "offset").alias("arrival"), "arrived")


def ingest_redelivered(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A topic's waves, each with all messages of the earlier ones once more, under an ingest that drops those."""
    root = shared_folder(spark, "redelivered")
    warehouse, dump = Warehouse(spark, f"{root}/warehouse").create(), f"{root}/dump"
    load_masters(spark, sf_dir, warehouse)
    for wave, end in enumerate(WAVES[1:]):
        messages = as_messages(given.arriving_events(spark, sf_dir, _shipped(WAVES[0], end)))
        messages.select("value", F.lit(0).alias("partition"), (F.lit(wave << 44) + F.monotonically_increasing_id()).alias("offset"),
                        F.current_timestamp().alias("arrived")).write.mode("append").parquet(dump, compression="zstd")
        drain(dumped_topic(spark, dump), warehouse, f"{root}/checkpoint", BOUNDED, seconds=None)
    return warehouse


_STORED: dict[tuple[str, str], Warehouse] = {}


def stored_months(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse after the waves of :func:`month_time`; made once in an application for all reports over it."""
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _STORED:
        _STORED[name] = ingest_waves(spark, sf_dir, OPEN, given.month_time())[0]
    return _STORED[name]


def load_all_masters(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Customers of one region, then all customers, products and stores, with what is refused."""
    warehouse = Warehouse(spark, f"{shared_folder(spark, 'masters')}/warehouse").create()
    customers = given.customer_master(spark, sf_dir)
    load_master(warehouse, "customers", customers.filter("region = 'ASIA'"), ["arrival"], "first")
    load_master(warehouse, "customers", customers, ["arrival"], "second")
    load_master(warehouse, "products", given.product_master(spark, sf_dir), ["arrival"], "products")
    load_master(warehouse, "stores", given.store_master(spark, sf_dir), ["arrival"], "stores")
    return warehouse
