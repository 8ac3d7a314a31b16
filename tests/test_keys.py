"""The index of order ids: only its buckets are read, and it survives a crash between any two writes."""

import json

import pytest
from pyspark.sql import functions as F

from orderloom.session import shared_folder
from orderloom.sinks import keys
from orderloom.sinks.warehouse import Warehouse, insert_if_absent
from orderloom.streaming.ingest import IngestOptions, load_batch

PLAIN = IngestOptions(dimensions=())


@pytest.fixture
def store(spark):
    return Warehouse(spark, shared_folder(spark, "keys")).create()


@pytest.fixture
def batch(spark, event):
    def messages(*changes):
        rows = [(json.dumps(event(**c)), i) for i, c in enumerate(changes)]
        return spark.createDataFrame(rows, "value string, n int").select("value", F.struct("n").alias("arrival"))
    return messages


def ids(store):
    return sorted((r["order_id"], r["brand"]) for r in store.read("orders").collect())


def in_step(store):
    """The index has the id and batch of every order, and no others; nothing is left open."""
    stored = {tuple(r) for r in store.read("orders").select("order_id", "ingest_batch").collect()}
    indexed = {tuple(r) for r in store.read("order_keys").select("order_id", "ingest_batch").collect()}
    return stored == indexed and store.read("open_batches").count() == 0


def test_an_id_is_found_whatever_its_date(store, batch):
    load_batch(store, batch({}, {"order_id": "o2"}), 0, "L-0", PLAIN)
    load_batch(store, batch({"brand": "moved", "order_timestamp": "2023-01-01T00:00:00"}, {"order_id": "o3"}), 1, "L-1", PLAIN)
    assert ids(store) == [("o1", "Acme"), ("o2", "Acme"), ("o3", "Acme")] and in_step(store)
    load_batch(store, batch({"brand": "moved", "order_timestamp": "2023-01-01T00:00:00"}, {"order_id": "o3"}), 1, "L-1", PLAIN)
    assert store.read("orders").count() == 3 and in_step(store)
    metrics = {r["ingest_batch"]: (r["consumed"], r["inserted"]) for r in store.read("batch_metrics").collect()}
    assert metrics == {"L-0": (2, 2), "L-1": (2, 1)}


def test_only_the_buckets_of_a_batch_are_read(spark, store, batch, monkeypatch):
    many = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("order_id"), F.lit("old").alias("ingest_batch"))
    store.append("order_keys", many.withColumn("bucket", keys.bucket_of(F.col("order_id"))))
    asked = many.limit(3)
    found = keys.indexed(store, asked)
    buckets = {f"bucket={r[0]}" for r in asked.select(keys.bucket_of(F.col("order_id"))).collect()}
    assert {path.split("/")[-2] for path in found.inputFiles()} == buckets
    assert found.join(asked, "order_id", "left_semi").count() == 3
    tables = []
    for name in ("read", "read_partitions"):
        real = getattr(Warehouse, name)
        monkeypatch.setattr(Warehouse, name, lambda self, table, *a, real=real: tables.append(table) or real(self, table, *a))
    load_batch(store, batch({"order_id": "k7"}, {}), 0, "L-0", PLAIN)
    assert "order_keys" in tables and "orders" not in tables
    monkeypatch.undo()
    assert ids(store) == [("o1", "Acme")]


def writes(monkeypatch, fail_at):
    """Makes the ``fail_at``-th write of any kind fail; returns the list of what was written."""
    done = []
    for name in ("append", "replace_partition", "drop_partition"):
        real = getattr(Warehouse, name)

        def write(self, table, *a, name=name, real=real):
            done.append(f"{name} {table}")
            if len(done) == fail_at:
                raise RuntimeError("lost")
            real(self, table, *a)

        monkeypatch.setattr(Warehouse, name, write)
    return done


def test_a_crash_before_any_write(store, batch, monkeypatch):
    """Each batch brings a stored id with another date, a new id and a bad row, and fails before another write."""
    load_batch(store, batch({}, {"order_id": "o2"}), 0, "L-0", PLAIN)
    done, fail_at, expected = [], 0, [("o1", "Acme"), ("o2", "Acme")]
    while fail_at <= len(done):
        fail_at += 1
        rows = batch({"order_id": "o2", "brand": "again", "order_timestamp": "2024-05-09T00:00:00"},
                     {"order_id": f"x{fail_at}"}, {"order_id": "bad", "quantity": 0})
        done = writes(monkeypatch, fail_at)
        try:
            load_batch(store, rows, fail_at, f"L-{fail_at}", PLAIN)
        except RuntimeError:
            monkeypatch.undo()
            load_batch(store, rows, fail_at, f"L-{fail_at}", PLAIN)
        else:
            monkeypatch.undo()
            assert fail_at > len(done) >= 7 and "append orders" in done  # all writes have failed once
        expected.append((f"x{fail_at}", "Acme"))
        assert ids(store) == expected, fail_at
        assert in_step(store), fail_at
        metrics = store.read("batch_metrics").filter(F.col("batch_id") == fail_at).select("consumed", "inserted", "invalid").collect()
        assert metrics == [(3, 1, 1)]


@pytest.mark.parametrize("fail_at", [3, 4])
def test_a_crash_around_the_orders_with_fixed_dates(store, batch, monkeypatch, fail_at):
    options = IngestOptions(dimensions=(), fixed_dates=True)
    writes(monkeypatch, fail_at)
    with pytest.raises(RuntimeError):
        load_batch(store, batch({}, {"order_id": "o2"}), 0, "L-0", options)
    monkeypatch.undo()
    load_batch(store, batch({}, {"order_id": "o2"}), 0, "L-0", options)
    assert ids(store) == [("o1", "Acme"), ("o2", "Acme")] and in_step(store)


def test_another_job_takes_up_what_a_dead_batch_stored(store, batch, monkeypatch):
    writes(monkeypatch, 4)  # rejects, note, orders, ids
    with pytest.raises(RuntimeError):
        load_batch(store, batch({}, {"order_id": "o2"}), 0, "dead-0", PLAIN)
    monkeypatch.undo()
    assert store.read("orders").count() == 2 and store.read("order_keys").count() == 0
    load_batch(store, batch({"brand": "later"}, {"order_id": "o5"}), 0, "new-0", PLAIN)
    assert ids(store) == [("o1", "Acme"), ("o2", "Acme"), ("o5", "Acme")] and in_step(store)


def test_fresh_ids_are_dealt_out(store, batch):
    for k in range(4):
        load_batch(store, batch({"order_id": f"o{k}"}, {"order_id": f"p{k}"}), k, f"L-{k}", PLAIN)
    assert len(store.files("order_keys", keys.FRESH)) == 4
    assert not keys.fold_keys(store, 4) and keys.fold_keys(store, 3)
    assert store.files("order_keys", keys.FRESH) == [] and in_step(store)
    assert all(r["bucket"] >= 0 for r in store.read("order_keys").collect())
    load_batch(store, batch({"order_id": "p2", "brand": "late"}, {"order_id": "q"}), 4, "L-4", PLAIN)
    assert store.read("orders").count() == 9 and in_step(store)


def test_large_batches_write_to_the_buckets(store, batch, monkeypatch):
    monkeypatch.setattr(keys, "DIRECT", 0)
    load_batch(store, batch({}, {"order_id": "o2"}), 0, "L-0", PLAIN)
    assert store.files("order_keys", keys.FRESH) == [] and in_step(store)


def test_an_index_is_made_for_a_warehouse_without_one(spark, store, batch):
    load_batch(store, batch({}, {"order_id": "o2"}), 0, "L-0", PLAIN)
    store.rename(store.path("order_keys"), store.path("gone"))
    again = Warehouse(spark, store.root).create()
    assert in_step(again)
    load_batch(again, batch({"brand": "later"}), 1, "L-1", PLAIN)
    assert ids(again) == [("o1", "Acme"), ("o2", "Acme")]
