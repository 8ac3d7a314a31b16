"""The summary kept by adding: equal to a recomputation, whatever comes late, again or is cut off."""

import datetime as dt
import json
import random
from decimal import Decimal

import pytest

from orderloom.plans import merged, rollup
from orderloom.schemas import ORDERS, SUMMARY_KEYS, SUMMARY_MEASURES, TOUCHED_DATES, ddl
from orderloom.session import shared_folder
from orderloom.sinks.warehouse import Warehouse


@pytest.fixture
def store(spark):
    return Warehouse(spark, shared_folder(spark, "merged")).create()


def order(number, day, customer="c1", category="Books", amount="10.00", **changes):
    """One stored order as a row of the orders table, without its batch."""
    made = dict.fromkeys(ORDERS) | {
        "order_id": f"o{number}", "order_timestamp": dt.datetime(2024, 5, day, 9), "customer_id": customer,
        "customer_region": "West", "category": category, "quantity": 2, "is_first_order": number % 3 == 0,
        "final_amount": amount and Decimal(amount), "tax_amount": Decimal("1.00"), "payment_method": "UPI",
        "order_status": ("Placed", "Delivered", "Returned")[number % 3], "order_date": dt.date(2024, 5, day)}
    return made | changes


def write(store, label, orders):
    rows = [tuple((each | {"ingest_batch": label})[name] for name in ORDERS) for each in orders]
    store.append("orders", store.spark.createDataFrame(rows, ddl(ORDERS)))


def note(store, label, *days):
    seq = rollup.last_batch(store.read("touched_dates")) + 1
    rows = [(dt.date(2024, 5, day), seq, label) for day in days]
    store.replace_partition("touched_dates", label, store.spark.createDataFrame(rows, ddl(TOUCHED_DATES)).coalesce(1))


def load(store, label, *orders):
    write(store, label, orders)
    note(store, label, *sorted({each["order_date"].day for each in orders}))


def columns(rows):
    return sorted((tuple(row) for row in rows.select(*SUMMARY_KEYS, *SUMMARY_MEASURES).collect()), key=str)


def check(store, orders=None):
    """The table holds what a recomputation over all orders gives."""
    assert columns(store.read("daily_summary")) == columns(rollup.daily_summary(orders or store.read("orders")))


def test_late_orders_are_added_to_their_day(store):
    load(store, "a-0", order(1, 1), order(2, 1, "c2"), order(3, 2), order(4, 1, "c1", "Toys"))
    assert merged.merge_daily_summary(store) == 1
    check(store)
    # A known customer, a new one, one known in another category, and one without id; amounts missing.
    load(store, "a-1", order(5, 1), order(6, 1, "c3"), order(7, 1, "c2", "Toys"), order(8, 1, None, amount=None),
         order(9, 4, None, "Beauty", None, tax_amount=None), order(10, 1, "c1", None), order(11, 1, "c1", None))
    load(store, "b-0", order(12, 1, "c3", "Toys", "0.01"), order(13, 1, "c3", amount="0.02"), order(14, 1, "c1", None))
    assert merged.merge_daily_summary(store) == 2
    check(store)
    day = store.read("daily_summary").filter("summary_date = '2024-05-01' and category = 'Books'").first()
    assert (day["total_orders"], day["unique_customers"], day["through_seq"]) == (6, 3, 3)
    assert store.read("daily_summary").filter("summary_date = '2024-05-02'").first()["through_seq"] == 1


def test_nothing_to_count(store):
    assert merged.merge_daily_summary(store) == 0
    load(store, "a-0", order(1, 1))
    merged.merge_daily_summary(store, "2024-05-05 00:00:00")
    note(store, "a-1")
    assert merged.merge_daily_summary(store, "2024-05-06 00:00:00") == 0
    assert store.read("daily_summary").first()["computed_at"] == dt.datetime(2024, 5, 5)
    assert merged.pending_batches(store).isEmpty()


def test_days_are_not_read_again(store):
    """Only the days of pending batches are read, and a condition on the batch reaches the scan."""
    load(store, "a-0", *(order(n, 1 + n % 3, f"c{n}") for n in range(30)))
    merged.merge_daily_summary(store)
    load(store, "a-1", order(40, 2))
    pending = merged.pending_batches(store)
    rows = merged.of_batches(store.read("orders").filter("order_date = '2024-05-02'"), pending)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ingest_batch,a-1)" in plan
    assert "PushedFilters: [" in plan and "ingest_batch" in plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    assert [row["order_id"] for row in rows.collect()] == ["o40"]
    # By a join where there are many names: the same rows.
    labels = store.spark.createDataFrame([(f"a-{n}",) for n in range(1, 30)], "ingest_batch string")
    for listed in (1000, 5):
        assert merged.of_batches(store.read("orders"), labels, listed).count() == 1
    assert merged.of_batches(store.read("orders"), labels.limit(0)).count() == 0


@pytest.mark.parametrize("lost", ["deltas", "customers", "batches", "notice", "summary", "published"])
def test_a_run_that_is_cut_off_is_taken_up(store, monkeypatch, lost):
    load(store, "a-0", order(1, 1), order(2, 2, "c2"))
    merged.merge_daily_summary(store)
    load(store, "a-1", order(3, 1), order(4, 1, "c3"))
    write_part, write_text, write_summary = merged._Parts.write, Warehouse.write_text, merged.write_summary

    def part(self, table, folder, rows):
        write_part(self, table, folder, rows)
        if table == lost:
            raise RuntimeError("lost")

    def text(self, path, content):
        name = path.rpartition("/")[2]
        if (lost, name[0]) in (("notice", "n"), ("published", "p")):
            raise RuntimeError("lost")
        write_text(self, path, content)

    def summary(*given):
        if lost == "summary":
            raise RuntimeError("lost")
        write_summary(*given)

    monkeypatch.setattr(merged._Parts, "write", part)
    monkeypatch.setattr(Warehouse, "write_text", text)
    monkeypatch.setattr(merged, "write_summary", summary)
    with pytest.raises(RuntimeError, match="lost"):
        merged.merge_daily_summary(store)
    monkeypatch.undo()
    # More arrives before the next run.
    load(store, "a-2", order(5, 3), order(6, 1, "c3"))
    merged.merge_daily_summary(store)
    check(store)
    assert merged.merge_daily_summary(store) == 0


def test_a_batch_that_is_repeated_is_not_counted_twice(store):
    load(store, "a-0", order(1, 1), order(2, 2))
    merged.merge_daily_summary(store)
    # It runs again, stores one order more than before, and notes its dates under a new number.
    load(store, "a-0", order(3, 1, "c5"))
    note(store, "a-0", 1, 2)
    load(store, "a-1", order(4, 1, "c6"), order(5, 3))
    assert merged.merge_daily_summary(store) == 2
    check(store)
    load(store, "a-2", order(6, 1, "c6"), order(7, 2, "c7"))
    merged.merge_daily_summary(store)
    check(store)


def test_a_batch_without_its_note(store):
    load(store, "a-0", order(1, 1))
    write(store, "a-1", [order(2, 1, "c2"), order(3, 2)])
    merged.merge_daily_summary(store)
    check(store, store.read("orders").filter("ingest_batch = 'a-0'"))
    # A whole count has it; so its note, when it comes, makes the days be counted whole once more.
    assert merged.merge_daily_summary(store, recount=[dt.date(2024, 5, 1), dt.date(2024, 5, 2)]) == 0
    check(store)
    note(store, "a-1", 1, 2)
    assert merged.merge_daily_summary(store) == 1
    check(store)


def test_many_runs_are_merged_by_levels(store):
    draw = random.Random(7)
    number = 0
    for run in range(11):
        batch = []
        for _ in range(draw.randint(1, 6)):
            number += 1
            batch.append(order(number, draw.randint(1, 3), draw.choice(["c1", "c2", "c3", "c4", None]),
                               draw.choice(["Books", "Toys", None]), f"{draw.randint(1, 999) / 100:.2f}"))
        load(store, f"a-{run}", *batch)
        again = run in (4, 7)
        if again:
            note(store, f"a-{run - 2}", 1, 2, 3)
        assert merged.merge_daily_summary(store, fan_in=3) == 1 + again
        check(store)
    parts = merged._Parts(store)
    assert len(parts.now["folders"]) <= 5 and parts.now["run"] == 11
    assert {name[1:] for name in parts.names if name[0] == "n"} == {"10", "11"}
    left = {name[5:] for name in store.names(f"{parts.root}/deltas") if name.startswith("part=")}
    assert left == {*parts.now["folders"], *parts.now["merged"]}
    assert json.loads(store.read_text(f"{parts.root}/n11"))["through"] == rollup.last_batch(store.read("touched_dates"))
