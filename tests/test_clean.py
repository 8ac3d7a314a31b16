import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators import clean, constraints
from orderloom.schemas import EVENT_FIELDS, ORDER_COLUMNS

NOW = dt.datetime(2024, 5, 5, 12)


def run(spark, events, extra_rules=()):
    """Clean one batch given in arrival order; ``{order_id, ...}`` rows of both sides by position."""
    rows = [[i] + [None if e.get(f) is None else str(e[f]) for f in EVENT_FIELDS] for i, e in enumerate(events)]
    raw = spark.createDataFrame(rows, "seq int, " + ", ".join(f"{f} string" for f in EVENT_FIELDS))
    valid, rejects = clean.transform(raw, ["seq"], extra_rules=extra_rules, ingested_at=NOW)
    return valid.collect(), rejects.collect()


def only_reason(spark, event, rules=(), **changes):
    valid, rejects = run(spark, [event(**changes)], rules)
    assert not valid
    return rejects[0]["reject_reasons"]


def test_clean_row(spark, event):
    valid, rejects = run(spark, [event()])
    row = valid[0].asDict()
    assert not rejects
    assert row["quantity"] == 2 and row["final_amount"] == Decimal("118.00")
    assert row["order_timestamp"] == dt.datetime(2024, 5, 5, 9, 30)
    assert row["ingested_at"] == NOW and row["order_hour"] == 9 and row["revenue_per_unit"] == Decimal("59.00")
    assert set(ORDER_COLUMNS) <= set(row)


def test_later_copy_is_refused(spark, event):
    valid, rejects = run(spark, [event(brand="one"), event(brand="two")])
    assert [r["brand"] for r in valid] == ["one"]
    assert [(r["brand"], r["reject_reason"]) for r in rejects] == [("two", "duplicate_in_batch")]


@pytest.mark.parametrize("quantity", ["abc", 0, -1, None, 0.4, "inf", "1d"])
def test_bad_quantity(spark, event, quantity):
    assert only_reason(spark, event, quantity=quantity) == ["bad_quantity"]


def test_fractional_quantity_rounds_away_from_zero(spark, event):
    assert run(spark, [event(quantity=2.5)])[0][0]["quantity"] == 3


@pytest.mark.parametrize("amount", [0.004, 0, -3, None, "x", "inf", 1e12])
def test_bad_amount(spark, event, amount):
    assert only_reason(spark, event, final_amount=amount) == ["bad_amount"]


@pytest.mark.parametrize("amount, stored", [(1.005, "1.00"), (0.125, "0.12"), (" 7.5 ", "7.50")])
def test_amounts_round_by_the_multiply_out_rule(spark, event, amount, stored):
    assert run(spark, [event(final_amount=amount)])[0][0]["final_amount"] == Decimal(stored)


def test_timestamps(spark, event):
    assert only_reason(spark, event, order_timestamp="garbage") == ["bad_timestamp"]
    valid, _ = run(spark, [event(order_timestamp="2024-05-05T09:30:00.5"), event(order_id="o2")])
    assert len(valid) == 2


def test_categories(spark, event):
    assert run(spark, [event(category=" Books\t")])[0][0]["category"] == "Books"
    assert only_reason(spark, event, category="books") == ["unknown_category"]
    assert only_reason(spark, event, category=None) == ["unknown_category"]


def test_missing_text_becomes_a_word(spark, event):
    row = run(spark, [event(order_status=None, payment_method=None, device_type=None, is_first_order=None)])[0][0]
    assert (row["order_status"], row["payment_method"], row["device_type"]) == ("None", "None", None)
    assert row["is_first_order"] is False


def test_missing_ids_count_as_one_id(spark, event):
    _, rejects = run(spark, [event(order_id=None), event(order_id=None, brand="two")])
    assert sorted(r["reject_reason"] for r in rejects) == ["duplicate_in_batch", "null_order_id"]


def test_bad_first_copy_takes_the_good_one_along(spark, event):
    valid, rejects = run(spark, [event(quantity=0), event()])
    assert not valid and [r["reject_reason"] for r in rejects] == ["bad_quantity", "duplicate_in_batch"]


def test_all_reasons_are_listed_and_text_is_kept(spark, event):
    _, rejects = run(spark, [event(quantity="abc", final_amount="-1", category="x")])
    assert rejects[0]["reject_reasons"] == ["bad_quantity", "bad_amount", "unknown_category"]
    assert rejects[0]["quantity"] == "abc" and rejects[0]["final_amount"] == "-1"


@pytest.mark.parametrize("changes, reason", [
    ({"event_timestamp": None}, "null_event_timestamp"), ({"unit_price": None}, "null_unit_price"),
    ({"total_amount": "x"}, "null_total_amount"), ({"unit_price": -1}, "negative_unit_price"),
])
def test_table_constraints(spark, event, changes, reason):
    assert only_reason(spark, event, constraints.order_rules(), **changes) == [reason]
    assert len(run(spark, [event(**changes)])[0]) == 1


def test_absent_fields_are_added(spark):
    raw = spark.createDataFrame([("o1", 1)], "order_id string, seq int")
    valid, rejects = clean.transform(raw, ["seq"], ingested_at=NOW)
    assert valid.count() == 0
    assert rejects.first()["reject_reasons"] == ["bad_quantity", "bad_amount", "bad_timestamp", "unknown_category"]


def test_empty_batch(spark):
    raw = spark.createDataFrame([], "order_id string, seq int")
    assert [side.count() for side in clean.transform(raw, ["seq"])] == [0, 0]


def test_sink_columns(spark):
    row = clean.sink_columns(spark.createDataFrame([("o1", 5)], "order_id string, extra int")).first()
    assert list(row.asDict()) == list(ORDER_COLUMNS)
    assert row["is_first_order"] is False and row["quantity"] is None


def test_rules_are_met_before_the_joins(spark, event):
    from orderloom.operators import clean
    from orderloom.operators.constraints import order_rules
    changes = [{}, {"quantity": "0"}, {"quantity": "abc"}, {"quantity": None}, {"final_amount": "0.004"}, {"category": " Books\t"},
               {"category": None}, {"order_timestamp": "garbage"}, {"unit_price": "-1"}, {"unit_price": None}, {"order_id": None},
               {"total_amount": None}, {"event_timestamp": None}, {"brand": "copy"}, {"order_status": None}]
    rows = [{k: None if v is None else str(v) for k, v in event(**{"order_id": f"o{n}"} | change).items()} | {"n": n, "known": n != 13}
            for n, change in enumerate(changes)]
    layout = ", ".join(f"{name} string" for name in clean.EVENT_FIELDS)
    events = spark.createDataFrame(rows, f"{layout}, n int, known boolean")
    raw = events.drop("brand").join(events.select("n", "brand").hint("shuffle_hash"), "n")
    valid, rejects = clean.transform(raw, ["n"], extra_rules=order_rules(), first="known")
    expected = clean.valid_orders(clean.tag_orders(raw, ["n"], extra_rules=order_rules(), first="known"))
    assert sorted(r["order_id"] for r in valid.collect()) == ["o0", "o14", "o5"]
    assert valid.drop("ingested_at").exceptAll(expected.drop("ingested_at")).count() == 0 and rejects.count() == 12
    _, _, below = valid._jdf.queryExecution().optimizedPlan().toString().partition("Join")
    assert "garbage" not in below and all(f"{name}#" in below[below.index("Filter"):] for name in ("known", "quantity", "unit_price"))


def test_rules_hold_without_a_flag_and_for_broken_messages(spark, event):
    from orderloom.operators import clean
    rows = [{k: str(v) for k, v in event(order_id=key).items()} | {"n": n, "payload": payload}
            for n, (key, payload) in enumerate([("a", None), ("a", None), ("b", "{"), ("b", None)])]
    raw = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in clean.EVENT_FIELDS) + ", n int, payload string")
    valid, rejects = clean.transform(raw, ["n"])
    assert sorted(r["order_id"] for r in valid.collect()) == ["a", "b"] and rejects.count() == 2
    flagged = clean.transform(raw.withColumn("known", F.col("n") != 1), ["n"], first="known")
    assert [sorted(r["order_id"] or "" for r in side.collect()) for side in flagged] == [["a", "b"], ["a", "b"]]
