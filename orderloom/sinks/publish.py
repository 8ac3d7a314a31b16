"""Order rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def publish_rows(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """``key`` and ``value`` columns for a topic: the value is a JSON object of all columns, NULLs included,
    with dates and timestamps as text. The key is the order id, so it spreads a customer's orders."""
    as_text = (T.DateType, T.TimestampType, T.TimestampNTZType)
    fields = [F.col(field.name).cast("string").alias(field.name) if isinstance(field.dataType, as_text)
              else F.col(field.name) for field in orders.schema.fields]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return orders.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def publish_to_kafka(orders: DataFrame, servers: str, topic: str, key: str = "order_id") -> None:
    """Send rows to a topic. Needs the Kafka connector on the class path."""
    (publish_rows(orders, key).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def publish_to_files(orders: DataFrame, path: str, key: str = "order_id") -> None:
    """Land the messages as JSON lines, for the file source."""
    publish_rows(orders, key).select("value").write.mode("append").text(path)
