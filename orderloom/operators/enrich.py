"""Price arithmetic and star enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.rounding import round_exact
from orderloom.schemas import CITY_REGIONS, DEFAULT_REGION, GST_RATE, MONEY


def price_orders(df: DataFrame, gst_rate: float = GST_RATE) -> DataFrame:
    """Add ``total_amount``, ``tax_amount`` and ``final_amount`` from ``unit_price`` and ``quantity``.

    The tax is the correctly rounded floating-point product, so that it agrees to the cent with amounts that
    were priced that way upstream; sums and whole multiples of cents are exact decimals. An amount
    that is too large for the column is null, so that the row is rejected alone."""
    total = (F.col("unit_price").try_cast(MONEY) * F.col("quantity")).try_cast(MONEY)
    return (df.withColumn("total_amount", total)
            .withColumn("tax_amount", round_exact(F.col("total_amount").cast("double") * gst_rate, 2).try_cast(MONEY))
            .withColumn("final_amount", (F.col("total_amount") + F.col("tax_amount")).try_cast(MONEY)))


def discount_prices(df: DataFrame) -> DataFrame:
    """Add ``discounted_price`` from ``original_price`` and ``discount_pct``."""
    kept = F.lit(1.0) - F.col("discount_pct") / F.lit(100.0)
    price = round_exact(F.col("original_price").cast("double") * kept, 2)
    return df.withColumn("discounted_price", price.cast(MONEY))


def add_region(df: DataFrame, city: str = "city", regions: DataFrame | None = None,
               default: str = DEFAULT_REGION) -> DataFrame:
    """Add ``region`` by city, ``default`` for cities without one.

    ``regions`` holds ``city`` (unique) and ``region``; without it the fixed city list is used, which is a
    literal of known size and therefore broadcast."""
    if regions is None:
        fixed = df.sparkSession.createDataFrame(list(CITY_REGIONS.items()), "city string, region string")
        regions = F.broadcast(fixed)
    lookup = regions.select(F.col("city").alias("_city"), F.col("region").alias("_region"))
    return (df.join(lookup, F.col(city) == F.col("_city"), "left")
            .withColumn("region", F.coalesce("_region", F.lit(default)))
            .drop("_city", "_region"))


def denormalize_orders(facts: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Widen order facts by the attributes of their customer, product and store.

    No join is forced to broadcast: Spark broadcasts a dimension whose size is below its threshold and otherwise
    shuffles, splitting partitions that a popular customer or product makes too large."""
    customer = customers.select(
        "customer_id", F.col("name").alias("customer_name"), F.col("city").alias("customer_city"),
        F.col("region").alias("customer_region"), F.col("age").alias("customer_age"),
        F.col("gender").alias("customer_gender"))
    product = products.select(
        "product_id", F.col("name").alias("product_name"), "category", "brand",
        F.col("discounted_price").alias("unit_price"))
    store = stores.select(
        "store_id", "store_name", "store_type", F.col("city").alias("store_city"),
        F.col("region").alias("store_region"))
    return facts.join(customer, "customer_id").join(product, "product_id").join(store, "store_id")
