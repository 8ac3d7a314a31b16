"""Master loads with two unique keys, redelivered messages, and arrivals packed into one number."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from orderloom.operators.clean import tag_orders
from orderloom.plans.masters import load_master
from orderloom.samples.streams import dumped_topic
from orderloom.session import shared_folder
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources.events import decode, landed_orders, with_arrival, with_number, without_redelivery
from orderloom.streaming.ingest import IngestOptions, drain


@pytest.fixture
def store(spark):
    return Warehouse(spark, shared_folder(spark, "loads")).create()


def customers(spark, *rows):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "customer_id string, name string, email string, seq int")


def stored(store):
    return sorted((r["customer_id"], r["name"], r["email"] or "") for r in store.read("customers").collect())


def refused(store, label):
    rows = store.read("master_rejects").filter(F.col("load_label") == label).collect()
    return sorted((r["row_key"] or "", json.loads(r["row_json"]).get("name"), ",".join(r["reject_reasons"])) for r in rows)


def test_no_email_is_stored_twice(spark, store):
    first = customers(spark, ("a", "A", "x@e"), ("b", "B", "x@e"), ("c", "C", None), ("d", "D", None), ("e", None, "y@e"),
                      ("f", "F", "y@e"), ("a", "again", "z@e"), (None, "none", "w@e"))
    assert load_master(store, "customers", first, ["seq"], "one") == 4
    assert stored(store) == [("a", "A", "x@e"), ("c", "C", ""), ("d", "D", ""), ("f", "F", "y@e")]
    assert refused(store, "one") == [("", "none", "null_customer_id"), ("b", "B", "duplicate_email"), ("e", None, "null_name")]
    second = customers(spark, ("a", "moved", "new@e"), ("g", "G", "y@e"), ("h", "H", "z@e"), ("i", "I", "z@e"), ("b", "B", "b@e"))
    assert load_master(store, "customers", second, ["seq"], "two") == 2
    assert {r[0]: r[2] for r in stored(store)} == {"a": "x@e", "b": "b@e", "c": "", "d": "", "f": "y@e", "h": "z@e"}
    assert refused(store, "two") == [("g", "G", "duplicate_email"), ("i", "I", "duplicate_email")]
    assert load_master(store, "customers", second, ["seq"], "two") == 0  # a repeat
    assert len(stored(store)) == 6 and refused(store, "two") == [("g", "G", "duplicate_email"), ("i", "I", "duplicate_email")]
    assert load_master(store, "customers", first.limit(0), ["seq"], "three") == 0 and refused(store, "three") == []


def test_other_masters(spark, store):
    stores = spark.createDataFrame([("s1", "Main", "Online", 1), ("s1", "Copy", "Online", 2), ("s2", "Odd", "Depot", 3)],
                                   "store_id string, store_name string, store_type string, seq int")
    assert load_master(store, "stores", stores, ["seq"], "s") == 1
    assert [(r["store_id"], r["store_name"]) for r in store.read("stores").collect()] == [("s1", "Main")]
    products = spark.createDataFrame([("p1", "Lamp", "Home", 1), ("p2", "Lamp", None, 2)], "product_id string, name string, category string, seq int")
    products = products.selectExpr("*", "cast(null as decimal(12,2)) as original_price", "cast(null as decimal(12,2)) as discounted_price",
                                   "cast(null as int) as discount_pct", "cast(4.5 as decimal(3,1)) as rating")
    assert load_master(store, "products", products, ["seq"], "p") == 1
    assert {(r["table_name"], r["row_key"], r["reject_reason"]) for r in store.read("master_rejects").collect()} == {
        ("stores", "s2", "bad_store_type"), ("products", "p2", "null_category")}


def test_redelivered_messages_are_dropped_across_restarts(spark, store, tmp_path, event):
    dump, checkpoint, count = str(tmp_path / "dump"), str(tmp_path / "cp"), itertools.count()
    one, two, bad = json.dumps(event()), json.dumps(event(order_id="o2", quantity=0)), "{cut"

    def land(*lines):
        rows = [(line, 0, next(count)) for line in lines]
        (spark.createDataFrame(rows, "value string, partition int, offset bigint").withColumn("arrived", F.current_timestamp())
         .write.mode("append").parquet(dump))
        assert drain(dumped_topic(spark, dump), store, checkpoint, IngestOptions(dimensions=(), redelivery="2 hours"), seconds=120)

    land(one, one, two, bad)  # twice in one batch
    land(one, bad, json.dumps(event(order_id="o3")))  # after a restart
    land(two, json.dumps(event(order_id="o2")), json.dumps(event(brand="other text")))
    assert sorted((r["order_id"], r["brand"]) for r in store.read("orders").collect()) == [("o1", "Acme"), ("o2", "Acme"), ("o3", "Acme")]
    assert store.read("batch_metrics").agg(F.sum("consumed")).first()[0] == 6
    assert sorted(r["reject_reason"] for r in store.read("rejects").collect()) == ["bad_quantity", "corrupt_json"]
    with pytest.raises(ValueError, match="arrival"):
        without_redelivery(landed_orders(spark, str(tmp_path)), "1 hour")


def test_packed_arrivals_keep_their_order(spark, tmp_path, event):
    for name in ("b", "a", "c"):
        (tmp_path / name).write_text("".join(json.dumps(event(order_id=f"{k % 40}", brand=f"{name}{k}")) + "\n" for k in range(400)))
    for size in ("1m", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            place = F.struct("_metadata.file_path", "_metadata.file_block_start").alias("place")
            lines = spark.read.text(str(tmp_path)).select("value", place)
            raw = decode(with_arrival(lines)).persist()
            numbered = with_number(raw)
            assert dict(numbered.dtypes)["arrival"] == "bigint" and set(numbered.columns) == set(raw.columns)
            order = [r["brand"] for r in numbered.orderBy("arrival").select("brand").collect()]
            assert order == [f"{name}{k}" for name in "abc" for k in range(400)]
            tagged = tag_orders(numbered, ["arrival"])
            assert "SortAggregate" not in tagged._jdf.queryExecution().executedPlan().toString()
            firsts = {r["order_id"]: r["brand"] for r in tagged.filter("size(reject_reasons) = 0").collect()}
            assert firsts == {f"{k}": f"a{k}" for k in range(40)}
            raw.unpersist()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    topic = spark.createDataFrame([("x", 2, 5), ("x", 1, 9), ("x", 1, 10)], "value string, partition int, offset bigint")
    topic = with_number(topic.select("value", F.struct("partition", "offset").alias("arrival"), "partition", "offset"))
    assert [(r["partition"], r["offset"]) for r in topic.orderBy("arrival").collect()] == [(1, 9), (1, 10), (2, 5)]
