import datetime as dt
from decimal import Decimal

from pyspark.sql.readwriter import DataFrameWriter

from orderloom.schemas import DAILY_SUMMARY, ORDERS, ddl
from orderloom.session import shared_folder
from orderloom.sinks.jdbc import append_jdbc
from orderloom.sinks.publish import publish_to_files
from orderloom.sinks.warehouse import TABLES, Warehouse


def summary(spark, *rows):
    layout = {name: DAILY_SUMMARY[name] for name in ("summary_date", "category", "total_orders", "total_revenue")}
    df = spark.createDataFrame([(dt.date(2024, 5, d), c, n, Decimal(n)) for d, c, n in rows], ddl(layout))
    return df.selectExpr(*(name if name in layout else f"cast(null as {kind}) as {name}"
                           for name, kind in DAILY_SUMMARY.items()))


def test_tables_are_created_once_and_typed(spark):
    store = Warehouse(spark, shared_folder(spark, "t")).create()
    store.append("daily_summary", summary(spark, (1, "a", 5)))
    store.create()
    assert store.read("daily_summary").count() == 1
    for name, spec in TABLES.items():
        assert {f.name for f in store.read(name).schema} == set(spec.layout)


def test_partitions_are_replaced_alone(spark):
    store = Warehouse(spark, shared_folder(spark, "t")).create()
    store.append("daily_summary", summary(spark, (1, "a", 5), (1, "b", 6), (2, "a", 7)))
    for _ in range(2):
        store.replace_partitions("daily_summary", summary(spark, (1, "c", 8)))
    rows = {(r["summary_date"].day, r["category"], r["total_orders"]) for r in store.read("daily_summary").collect()}
    assert rows == {(1, "c", 8), (2, "a", 7)}


def test_reading_some_partitions(spark):
    store = Warehouse(spark, shared_folder(spark, "t")).create()
    days = [dt.date(2024, 5, d) for d in (1, 2, 9)]
    assert store.read_partitions("daily_summary", days).count() == 0
    store.append("daily_summary", summary(spark, (1, "a", 5), (2, "b", 6), (3, "c", 7)))
    got = store.read_partitions("daily_summary", days)
    assert {(r["summary_date"], r["category"]) for r in got.collect()} == {(days[0], "a"), (days[1], "b")}
    assert store.read_partitions("daily_summary", days[2:]).count() == 0
    assert store.read_partitions("orders", []).columns == list(ORDERS)


def test_messages_land_as_lines(spark, tmp_path):
    rows = spark.sql("select 'o1' as order_id, 2 as quantity")
    for _ in range(2):
        publish_to_files(rows, str(tmp_path / "landing"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "landing")).collect()] == ['{"order_id":"o1","quantity":2}'] * 2


def test_jdbc_options(spark, monkeypatch):
    """Without a driver here, look at what the writer is told."""
    told = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: told.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: told.update(saved=True))
    append_jdbc(spark.range(1), "jdbc:x", "orders", {"user": "u"})
    assert told == {"url": "jdbc:x", "dbtable": "orders", "batchsize": "100", "user": "u", "saved": True}
