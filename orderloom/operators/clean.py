"""Cleaning of raw order events: one pass that types every field, applies all rules and splits the rows.

Raw events are text columns named as in ``EVENT_FIELDS``. Each row ends on exactly one side: valid orders, or
rejects that keep the text as it came and every reason for the refusal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions import coerce
from orderloom.functions.calendar import Instant, instant
from orderloom.functions.rounding import round_scaled
from orderloom.operators.firsts import tag_first
from orderloom.schemas import CATEGORIES, DERIVED_COLUMNS, EVENT_FIELDS, MONEY, ORDER_COLUMNS, REQUIRED_FIELDS

Rule = tuple[str, Column]

_MONEY_FIELDS = ("unit_price", "total_amount", "tax_amount", "final_amount")
_STRIPPED_FIELDS = ("category", "order_status", "payment_method", "customer_city", "customer_region", "store_type")


def with_required_fields(raw: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Add the fields a source does not have, as NULL."""
    missing = [name for name in fields if name not in raw.columns]
    return raw.withColumns({name: F.lit(None).cast("string") for name in missing}) if missing else raw


def typed_columns(ingested_at: Instant = None) -> dict[str, Column]:
    """The stored form of each order column as an expression over the raw text."""
    numbers = {name: coerce.number_or_null(F.col(name)) for name in (*_MONEY_FIELDS, "quantity", "customer_age")}
    columns = {name: F.col(name) for name in ORDER_COLUMNS}
    for name in ("order_timestamp", "event_timestamp"):
        columns[name] = coerce.timestamp_or_null(F.col(name))
    for name in _MONEY_FIELDS:
        columns[name] = coerce.money_or_null(numbers[name])
    for name in ("quantity", "customer_age"):
        columns[name] = coerce.whole_or_null(numbers[name])
    for name in _STRIPPED_FIELDS:
        columns[name] = coerce.stripped_text(F.col(name))
    columns["is_first_order"] = coerce.truth(F.col("is_first_order"))
    per_unit = round_scaled(numbers["final_amount"], 2) / F.nullif(numbers["quantity"], F.lit(0.0))
    columns["ingested_at"] = instant(ingested_at)
    columns["revenue_per_unit"] = coerce.money_or_null(per_unit)
    columns["order_hour"] = F.hour(columns["order_timestamp"])
    return columns


def business_rules(categories: Sequence[str] = CATEGORIES) -> list[Rule]:
    """Reasons to refuse a typed order, each with the condition under which it applies."""
    return [
        ("null_order_id", F.col("order_id").isNull()),
        ("bad_quantity", F.coalesce(F.col("quantity"), F.lit(0)) <= 0),
        ("bad_amount", F.coalesce(F.col("final_amount"), F.lit(0).cast(MONEY)) <= 0),
        ("bad_timestamp", F.col("order_timestamp").isNull()),
        ("unknown_category", ~F.coalesce(F.col("category").isin(*categories), F.lit(False))),
    ]


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of all rules that apply to a row. A condition that is NULL does not apply."""
    return F.array_compact(F.array(*(F.when(broken, F.lit(name)) for name, broken in rules)))


def tag_orders(raw: DataFrame, arrival: list[str], categories: Sequence[str] = CATEGORIES,
               extra_rules: Sequence[Rule] = (), ingested_at: Instant = None, first: str | None = None,
               marks: Sequence[Rule] = ()) -> DataFrame:
    """Typed orders with ``reject_reasons`` (empty when valid) and the ``raw`` text they came from.

    Repeats are settled before the rules, so a bad first copy takes the good second one down with it.
    A row with ``payload`` set is one that could not be decoded. ``first`` names a flag of ``raw`` that tells first
    copies already, where :func:`tag_first` was cheaper before the events became wide; ``arrival`` is not looked at then.
    ``marks`` are conditions on columns of ``raw``, whose reasons follow whatever else was found. As they are told before
    the text is typed, a reader of the valid orders types those alone."""
    raw = with_required_fields(raw, (*EVENT_FIELDS, "payload"))
    decoded = F.col("payload").isNull()
    tagged = (raw.withColumnRenamed(first, "_first") if first else
              tag_first(raw, ["order_id"], arrival, flag="_first", among=decoded))
    text = F.struct(*EVENT_FIELDS, "payload")
    typed = tagged.select(*(col.alias(name) for name, col in typed_columns(ingested_at).items()),
                          text.alias("raw"), "_first", *([reasons(marks).alias("_marks")] if marks else []))
    found = (F.when(F.col("raw.payload").isNotNull(), F.array(F.lit("corrupt_json")))
             .when(~F.col("_first"), F.array(F.lit("duplicate_in_batch")))
             .otherwise(reasons([*business_rules(categories), *extra_rules])))
    return typed.withColumn("reject_reasons", F.concat(found, "_marks") if marks else found).drop("_first", "_marks")


def valid_orders(tagged: DataFrame) -> DataFrame:
    return tagged.filter(_accepted()).select(*ORDER_COLUMNS, *DERIVED_COLUMNS)


def rejected_orders(tagged: DataFrame) -> DataFrame:
    return (tagged.filter(~_accepted())
            .select("raw.*", F.col("reject_reasons")[0].alias("reject_reason"), "reject_reasons"))


def transform(raw: DataFrame, arrival: list[str], categories: Sequence[str] = CATEGORIES,
              extra_rules: Sequence[Rule] = (), ingested_at: Instant = None,
              first: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)`` of one batch of raw events.

    No row breaks a rule and is valid, so the rules are conditions on the events as well, each by itself: what it looks
    at tells how far down it can be met, at best where a table is read, before the rows are joined and shuffled. That
    holds for ``first`` too, which is told of all events before any is left out."""
    rules = [*business_rules(categories), *extra_rules]
    kept = _unbroken(raw, rules).filter(first) if first else raw
    return (valid_orders(tag_orders(kept, arrival, categories, extra_rules, ingested_at, first)),
            rejected_orders(tag_orders(raw, arrival, categories, extra_rules, ingested_at, first)))


def _unbroken(raw: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Events that can be decoded and break no rule once they are typed."""
    typed = [col.alias(name) for name, col in typed_columns().items()]
    events = with_required_fields(raw, (*EVENT_FIELDS, "payload")).filter(F.col("payload").isNull())
    checked = events.select(F.struct(*raw.columns).alias("_event"), *typed)
    for _, broken in rules:
        checked = checked.filter(~F.coalesce(broken, F.lit(False)))
    return checked.select("_event.*")


def sink_columns(orders: DataFrame) -> DataFrame:
    """The columns an order is loaded with, by name: absent ones NULL, ``is_first_order`` false."""
    present = set(orders.columns)
    columns = {name: (F.col(name) if name in present else F.lit(None)).cast(kind)
               for name, kind in ORDER_COLUMNS.items()}
    columns["is_first_order"] = F.coalesce(columns["is_first_order"], F.lit(False))
    return orders.select(*(col.alias(name) for name, col in columns.items()))


def _accepted() -> Column:
    return F.size("reject_reasons") == 0
