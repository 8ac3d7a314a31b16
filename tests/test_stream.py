import json
import os
import time

import pytest
from pyspark.sql import functions as F

from orderloom.plans.hourly import run_hourly
from orderloom.plans.quality import QualityError
from orderloom.session import shared_folder
from orderloom.sinks import warehouse
from orderloom.sinks.publish import publish_rows
from orderloom.sinks.warehouse import Warehouse, insert_if_absent
from orderloom.sources.events import decode, kafka_options, landed_orders
from orderloom.streaming.ingest import IngestOptions, drain, ingest_totals, load_batch, start_live


@pytest.fixture
def store(spark):
    """An empty warehouse with one customer, product and store."""
    made = Warehouse(spark, shared_folder(spark, "store")).create()
    for table, key, sql in (
            ("customers", "customer_id", "select 'c1' as customer_id, 'Asha' as name, 1 as seq"),
            ("products", "product_id", "select 'p1' as product_id, 'Lamp' as name, 'Books' as category, 1 as seq"),
            ("stores", "store_id", "select 's1' as store_id, 'Main' as store_name, 1 as seq")):
        insert_if_absent(made, table, spark.sql(sql), key, ["seq"])
    return made


@pytest.fixture
def landing(tmp_path):
    """``land(name, events)`` writes one file of messages; text is written as it is."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, *events):
        text = "".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events)
        (tmp_path / name).write_text(text)
        os.replace(tmp_path / name, folder / name)

    land.folder = str(folder)
    return land


def run(spark, store, landing, checkpoint, **options):
    stream = landed_orders(spark, landing.folder, files_per_batch=1, by_name=True)
    return drain(stream, store, checkpoint, IngestOptions(**options), seconds=120)


def stored(store):
    return {(r["order_id"], r["brand"]) for r in store.read("orders").collect()}


def refused(store):
    return sorted((r["order_id"] or "", r["reject_reason"]) for r in store.read("rejects").collect())


def test_two_batches_and_a_replay(spark, store, landing, tmp_path, event):
    landing("a.json", event(), event(brand="late copy"), event(order_id="bad", quantity=0),
            event(order_id="nocust", customer_id="c9"), event(order_id="notime", event_timestamp=None),
            "{not json", event(order_id=None))
    landing("b.json", event(brand="next batch"), event(order_id="bad", brand="good copy"),
            event(order_id="o2", category=" Toys "))
    assert run(spark, store, landing, str(tmp_path / "cp"))
    expected = {("o1", "Acme"), ("bad", "good copy"), ("o2", "Acme")}
    assert stored(store) == expected
    rejects = [("", "corrupt_json"), ("", "null_order_id"), ("bad", "bad_quantity"), ("nocust", "orphan_customer"),
               ("notime", "null_event_timestamp"), ("o1", "duplicate_in_batch")]
    assert refused(store) == rejects
    assert store.read("rejects").filter("reject_reason = 'corrupt_json'").first()["payload"] == "{not json"
    totals = ingest_totals(store.read("batch_metrics")).first().asDict()
    assert totals == {"consumed": 10, "inserted": 3, "invalid": 6, "failed": 0, "success_rate": 30.0}
    assert run(spark, store, landing, str(tmp_path / "cp"))
    assert store.read("batch_metrics").count() == 2
    assert run(spark, store, landing, str(tmp_path / "fresh"))
    assert stored(store) == expected and store.read("orders").count() == 3


def test_a_batch_that_fails_after_its_insert_is_repeated(spark, store, landing, tmp_path, event, monkeypatch):
    landing("a.json", event(), event(order_id="o2", quantity="x"), event(order_id="o3"))
    real = Warehouse.replace_partition

    def fail_once(self, table, value, rows):
        if table == "touched_dates":
            raise RuntimeError("lost")
        real(self, table, value, rows)

    monkeypatch.setattr(Warehouse, "replace_partition", fail_once)
    with pytest.raises(Exception, match="lost"):
        run(spark, store, landing, str(tmp_path / "cp"))
    assert store.read("orders").count() == 2
    assert store.read("batch_metrics").count() == 0
    monkeypatch.setattr(Warehouse, "replace_partition", real)
    assert run(spark, store, landing, str(tmp_path / "cp"))
    assert store.read("orders").count() == 2 and store.read("rejects").count() == 1
    metrics = store.read("batch_metrics").first()
    assert (metrics["consumed"], metrics["inserted"], metrics["invalid"]) == (3, 2, 1)


@pytest.mark.parametrize("most", [300, 1])
def test_search_within_the_batch_dates(spark, store, landing, tmp_path, event, monkeypatch, most):
    monkeypatch.setattr(warehouse, "PATTERN_VALUES", most)
    landing("a.json", event(), event(order_id="o2", order_timestamp="2024-05-09T00:00:00"))
    landing("b.json", event(brand="again"), event(order_id="o3", order_timestamp="2024-05-07T00:00:00"),
            event(order_id="o2", brand="again", order_timestamp="2024-05-09T00:00:00"))
    landing("c.json", event(order_id="o3", brand="moved", order_timestamp="2024-05-01T00:00:00"), event(order_id="o4"))
    run(spark, store, landing, str(tmp_path / "cp"), fixed_dates=True)
    # A broken promise is stored again, whether one pattern lists the dates or several.
    assert stored(store) == {("o1", "Acme"), ("o2", "Acme"), ("o3", "Acme"), ("o3", "moved"), ("o4", "Acme")}


def test_a_repeated_batch_drops_its_former_rejects(spark, store, event):
    messages = spark.createDataFrame([(json.dumps(event(customer_id="late")), 1)], "value string, n int").select(
        "value", F.struct("n").alias("arrival"))
    load_batch(store, messages, 0, "L-0")
    assert store.read("rejects").count() == 1 and store.read("touched_dates").count() == 0
    insert_if_absent(store, "customers", store.read("customers").limit(1).withColumn("customer_id", F.lit("late")),
                     "customer_id", ["customer_id"])
    load_batch(store, messages, 0, "L-0")
    assert store.read("rejects").count() == 0 and store.read("orders").count() == 1
    assert store.read("touched_dates").count() == 1
    assert store.read("batch_metrics").select("invalid").first()[0] == 0


def test_a_load_without_a_key_is_refused(spark, store):
    rows = spark.sql("select cast(null as string) as customer_id, 'x' as name, 1 as seq")
    with pytest.raises(ValueError, match="customer_id"):
        insert_if_absent(store, "customers", rows, "customer_id", ["seq"])
    assert store.read("customers").count() == 1


def test_only_whole_messages_are_decoded(spark, event):
    good = json.dumps(event())
    flawed = [good + good, good + " trailing", good.replace('"', "'"), f"[{good}]", good + ',"_end":"1"', good + "] x",
              "", "null", "7", good[:-1], None]
    rows = spark.createDataFrame([(x,) for x in [good, f" {good}\n", "{}", *flawed]], "value string")
    got = decode(rows).select("order_id", "payload").collect()
    assert [r["order_id"] for r in got] == ["o1", "o1", None] + [None] * len(flawed)
    assert [r["payload"] for r in got] == [None] * 3 + [x or "" for x in flawed]


def test_totals_are_told_when_a_drain_ends_or_fails(spark, store, landing, tmp_path, event, monkeypatch):
    def totals():
        told = []
        stream = landed_orders(spark, landing.folder, files_per_batch=1, by_name=True)
        try:
            drain(stream, store, str(tmp_path / "cp"), seconds=120, report=told.append)
        finally:
            assert len(told) == 1
            assert (told[0]["error"] is not None) == bool(told[0]["failed"])
            seen.append([told[0][name] for name in ("batches", "consumed", "inserted", "invalid", "failed")])

    seen = []
    landing("a.json", event(), event(order_id="o2", quantity=0))
    landing("b.json", event(brand="again"), event(order_id="o3"))
    totals()
    assert seen.pop() == [2, 4, 2, 1, 0]
    landing("c.json", event(order_id="o4"))
    real = Warehouse.replace_partition

    def fail(self, table, value, rows):
        if table == "touched_dates":
            raise RuntimeError("lost")
        real(self, table, value, rows)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "replace_partition", fail)
        for _ in range(2):
            with pytest.raises(Exception, match="lost"):
                totals()
            assert seen.pop() == [0, 0, 0, 0, 1]
    totals()
    assert seen.pop() == [1, 1, 1, 0, 0]
    attempts = store.read("failed_attempts").collect()
    assert len(attempts) == 2 and "lost" in attempts[0]["error"]
    assert {r["batch_id"]: r["failed"] for r in store.read("batch_metrics").collect()} == {0: 0, 1: 0, 2: 2}
    assert ingest_totals(store.read("batch_metrics")).first()["failed"] == 2
    totals()
    assert seen.pop() == [0, 0, 0, 0, 0]


def test_counters_of_batches_without_rows_or_news(spark, store, event):
    def batch(*events):
        rows = [(json.dumps(e), i) for i, e in enumerate(events)]
        return spark.createDataFrame(rows, "value string, n int").select("value", F.struct("n").alias("arrival"))

    assert load_batch(store, batch(), 0, "L-0") == {"consumed": 0, "invalid": 0, "inserted": 0, "failed": 0}
    assert load_batch(store, batch(event()), 1, "L-1")["inserted"] == 1
    known = load_batch(store, batch(event(), event(order_id="bad", quantity=0)), 2, "L-2")
    assert known == {"consumed": 2, "invalid": 1, "inserted": 0, "failed": 0}


def test_live_job_takes_files_as_they_come(spark, store, landing, tmp_path, event):
    landing("a.json", event())
    told = []
    query = start_live(landed_orders(spark, landing.folder), store, str(tmp_path / "cp"), report=told.append)
    try:
        query.processAllAvailable()
        landing("b.json", event(order_id="o2"))
        deadline = time.time() + 60
        while store.read("orders").count() < 2 and time.time() < deadline:
            query.processAllAvailable()
    finally:
        query.stop()
    assert stored(store) == {("o1", "Acme"), ("o2", "Acme")}
    deadline = time.time() + 20
    while not told and time.time() < deadline:
        time.sleep(0.1)
    assert [(t["consumed"], t["inserted"], t["failed"], t["error"]) for t in told] == [(2, 2, 0, None)]


def test_hourly_job_counts_late_orders_and_stops_at_the_gate(spark, store, landing, tmp_path, event):
    def hourly(which, as_of="2024-05-05 12:00:00"):
        stream = landed_orders(spark, landing.folder, by_name=True)
        return run_hourly(stream, store, str(tmp_path / "cp"), as_of, dates=which).first()

    def summary():
        return {(r["summary_date"].day, r["total_orders"]) for r in store.read("daily_summary").collect()}

    landing("a.json", event(), event(order_id="o2", order_timestamp="2024-05-01T00:00:00"))
    row = hourly("today")
    assert (row["consumed"], row["inserted"], row["categories"], row["total_orders"]) == (2, 2, 1, 1)
    assert summary() == {(5, 1)}
    landing("b.json", event(order_id="o3", order_timestamp="2024-05-01T10:00:00"))
    assert hourly("stale")["inserted"] == 1
    assert summary() == {(5, 1), (1, 2)}
    landing("c.json", event(order_id="o4", order_timestamp="2024-05-20T00:00:00"))
    with pytest.raises(QualityError, match="future_orders"):
        hourly("stale")
    assert summary() == {(5, 1), (1, 2)}
    with pytest.raises(ValueError):
        hourly("tomorrow")


def test_decoding(spark):
    messages = spark.createDataFrame(
        [('{"order_id": "a", "quantity": 2, "final_amount": 1.50, "is_first_order": true, "more": [1]}',),
         ("[1]",), ("null",), ("7",), (None,), ("{",), ("",)], "value string")
    got = decode(messages).collect()
    first = got[0].asDict()
    assert (first["order_id"], first["quantity"], float(first["final_amount"]), first["is_first_order"]) == (
        "a", "2", 1.5, "true")
    assert [r["payload"] for r in got] == [None, "[1]", "null", "7", "", "{", ""]


def test_published_rows_come_back(spark):
    orders = spark.sql("select 'o1' as order_id, timestamp_ntz '2024-05-05 09:30:00' as order_timestamp, "
                       "cast(118 as decimal(12,2)) as final_amount, cast(null as string) as brand")
    row = publish_rows(orders).first()
    assert row["key"] == "o1"
    assert json.loads(row["value"]) == {"order_id": "o1", "order_timestamp": "2024-05-05 09:30:00",
                                        "final_amount": 118.00, "brand": None}


def test_kafka_reader_options():
    assert kafka_options("h:9092", "orders", 100) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "orders", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100"}
    assert "maxOffsetsPerTrigger" not in kafka_options("h:9092", "orders")


def test_a_batch_holds_nothing_wide_and_leaves_no_stage(spark, store, event, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    rows = [(json.dumps(event(**change)), n) for n, change in enumerate((
        {}, {"brand": "later"}, {"order_id": None}, {"order_id": None}, {"customer_id": "c9", "order_id": "o2"},
        {"customer_id": "c9", "quantity": 0, "order_id": "o3"}, {"customer_id": "c9", "brand": "later"}))]
    messages = spark.createDataFrame(rows, "value string, n int").select("value", F.struct("n").alias("arrival"))
    widths, real = [], DataFrame.persist

    def persist(self, *level):
        widths.append(len(self.columns))
        return real(self, *level)

    monkeypatch.setattr(DataFrame, "persist", persist)
    counts = load_batch(store, messages, 0, "L-0")
    assert max(widths) <= 2
    assert counts == {"consumed": 7, "invalid": 6, "inserted": 1, "failed": 0}
    assert sorted((r["order_id"] or "", ",".join(r["reject_reasons"])) for r in store.read("rejects").collect()) == [
        ("", "duplicate_in_batch"), ("", "null_order_id"), ("o1", "duplicate_in_batch"),
        ("o1", "duplicate_in_batch,orphan_customer"), ("o2", "orphan_customer"), ("o3", "bad_quantity,orphan_customer")]
    assert store.names(store.path("_staged")) == []
    monkeypatch.setattr(Warehouse, "append", lambda *given: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load_batch(store, messages, 1, "L-1")
    assert store.names(store.path("_staged")) == []


def test_orders_are_typed_after_the_rejects_are_left_out(spark, event):
    from orderloom.operators.clean import tag_orders, valid_orders
    raw = spark.createDataFrame([{k: str(v) for k, v in event().items()}]).withColumns({"_first": F.lit(True), "lost": F.rand() < 0})
    tagged = tag_orders(raw, [], first="_first", marks=[("lost", F.col("lost"))])
    plan = valid_orders(tagged)._jdf.queryExecution().optimizedPlan().toString()
    typing, _, below = plan.partition("Filter")
    assert typing.count("rim(") >= 6 and "customer_age" in typing and "rim(customer_city" not in below


@pytest.mark.parametrize("text, whole", [('{"order_id": "a"}', True), ('{"order_id": "a"} \n', True), ('{"order_id": "}"}', True),
                                         ('{"order_id": {"b": 1}}', True), ('{"order_id": "a"}}', False), ("}", False),
                                         ('{"order_id": "a"}{', False), ('{"order_id": "\u00e9\u20ac"}', True)])
def test_bytes_behind_the_closing_brace(spark, text, whole):
    row = decode(spark.createDataFrame([(text,)], "value string"), ["order_id"]).first()
    assert (row["payload"] is None) == whole


def test_stripping_looks_at_the_ends_only(spark):
    from orderloom.functions.coerce import _SPACES, stripped_text
    words = ["a", " a", "a\t", "\u00a0a\u3000", "\u00e9", "a b", "", " ", "~", "!a\x1f", "\u2009\u00e9x", "x\u00e9\u2009", None]
    got = spark.createDataFrame([(w,) for w in words], "t string").select(stripped_text(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in got] == ["None" if w is None else w.strip(_SPACES) for w in words]


def test_waves_are_ordered_before_they_are_widened(spark, tmp_path):
    from orderloom.samples import streams, tables as given
    from orderloom.schemas import ddl
    made = {"region": (1, "EAST"), "nation": (1, "PERU", 1), "customer": (1, "C", 1, 5.0, "AUTO"), "supplier": (1, "S", 1, 5.0),
            "part": (1, "P", "B", "PROMO", 7, 9.5)}
    at = "timestamp_ntz '1996-01-0{} 00:00:00'"
    for name, row in made.items():
        spark.createDataFrame([row], ddl(given.LAYOUTS[name])).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.sql(f"select 1L as o_orderkey, 1L as o_custkey, 'O' as o_orderstatus, 1d as o_totalprice, {at.format(1)} as o_orderdate, "
              "'5-LOW' as o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    lines = " union all ".join(
        f"select 1L as l_orderkey, 1L as l_partkey, 1L as l_suppkey, {n} as l_linenumber, 2d as l_quantity, 3d as l_extendedprice, "
        f"0d as l_discount, 0d as l_tax, 'N' as l_returnflag, 'O' as l_linestatus, {at.format(9 - n)} as l_shipdate" for n in (1, 2, 3))
    spark.sql(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    events = given.arriving_events(spark, str(tmp_path), streams._shipped("1996-01-01", "1996-01-08"))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("date_format") < plan.index("RepartitionByExpression") < plan.index("Join")
    assert [r["order_id"] for r in events.collect()] == ["1-3", "1-2"]
