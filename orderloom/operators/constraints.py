"""Table constraints as row predicates: offending rows go to rejects, the rest of the batch is kept."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.operators.clean import Rule, reasons
from orderloom.operators.firsts import tag_first
from orderloom.schemas import GENDERS, STORE_TYPES, TEXT_LIMITS, UUID_COLUMNS

_UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


class ForeignKey(NamedTuple):
    """Column of the orders, key column of the dimension it must be found in, and the reason if it is not."""

    column: str
    key: str
    reason: str


FOREIGN_KEYS = {
    "customers": ForeignKey("customer_id", "customer_id", "orphan_customer"),
    "products": ForeignKey("product_id", "product_id", "orphan_product"),
    "stores": ForeignKey("store_id", "store_id", "orphan_store"),
}


def _missing(*names: str) -> list[Rule]:
    return [(f"null_{name}", F.col(name).isNull()) for name in names]


def _outside(name: str, low, high) -> Rule:
    return f"bad_{name}", ~F.col(name).between(low, high)


def _negative(name: str) -> Rule:
    return f"negative_{name}", F.col(name) < 0


def _not_one_of(name: str, words: tuple[str, ...]) -> Rule:
    return f"bad_{name}", ~F.col(name).isin(*words)


def customer_rules() -> list[Rule]:
    return [*_missing("customer_id", "name"), _outside("age", 0, 120), _not_one_of("gender", GENDERS)]


def product_rules() -> list[Rule]:
    return [*_missing("product_id", "name", "category"), _negative("original_price"),
            _negative("discounted_price"), _outside("discount_pct", 0, 100), _outside("rating", 1, 5)]


def store_rules() -> list[Rule]:
    return [*_missing("store_id", "store_name"), _not_one_of("store_type", STORE_TYPES)]


def order_rules() -> list[Rule]:
    """Constraints on orders that the business rules do not cover already."""
    return [*_missing("event_timestamp", "unit_price", "total_amount"), _negative("unit_price")]


def format_rules(table: str) -> list[Rule]:
    """Optional: identifiers must be UUIDs and text must fit its column."""
    ids = [(f"malformed_{name}", ~F.col(name).rlike(_UUID)) for name in UUID_COLUMNS[table]]
    return ids + [(f"long_{name}", F.length(name) > limit) for name, limit in TEXT_LIMITS[table].items()]


def tag_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Append the names of broken rules to ``reject_reasons``. As in SQL, NULL passes a check."""
    found = reasons(rules)
    if "reject_reasons" in df.columns:
        found = F.concat("reject_reasons", found)
    return df.withColumn("reject_reasons", found)


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` rows of a tagged table."""
    clean = F.size("reject_reasons") == 0
    return tagged.filter(clean).drop("reject_reasons"), tagged.filter(~clean)


def orphan_keys(orders: DataFrame, table: str, dimension: DataFrame) -> DataFrame:
    """Distinct foreign keys of ``orders`` that the dimension ``table`` lacks. They are made distinct before the
    join, so a key shared by many orders crosses the network once per task."""
    link = FOREIGN_KEYS[table]
    used = orders.select(F.col(link.column).alias(link.key)).filter(F.col(link.key).isNotNull()).distinct()
    return used.join(dimension.select(link.key), link.key, "left_anti")


def mark_orphans(orders: DataFrame, lost: dict[str, DataFrame]) -> tuple[DataFrame, list[Rule]]:
    """``orders`` with a column for each dimension, which is null where the key is not in ``lost``, the
    :func:`orphan_keys` of that dimension; and the rules on these columns. No key is marked that is NULL."""
    rules: list[Rule] = []
    for table, keys in lost.items():
        link = FOREIGN_KEYS[table]
        mark = f"_lost_{table}"
        orders = orders.join(keys.select(F.col(link.key).alias(mark)), F.col(link.column) == F.col(mark), "left")
        rules.append((link.reason, F.col(mark).isNotNull()))
    return orders, rules


def tag_orphans(orders: DataFrame, lost: dict[str, DataFrame]) -> DataFrame:
    """Append ``orphan_*`` to ``reject_reasons`` of orders with a key in ``lost``, as :func:`mark_orphans` finds them."""
    tagged, rules = mark_orphans(orders if "reject_reasons" in orders.columns else tag_violations(orders, []), lost)
    return tag_violations(tagged, rules).drop(*(f"_lost_{table}" for table in lost))


def tag_unmatched(orders: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Append ``orphan_*`` to ``reject_reasons`` of orders whose key a dimension lacks, in one pass over the orders:
    they meet the distinct keys of each dimension. For orders that are not held in memory; no NULL key is tagged."""
    tagged = orders if "reject_reasons" in orders.columns else tag_violations(orders, [])
    rules: list[Rule] = []
    marks: list[str] = []
    for table, dimension in dimensions.items():
        link = FOREIGN_KEYS[table]
        mark = f"_held_{table}"
        keys = dimension.select(F.col(link.key).alias(mark)).filter(F.col(mark).isNotNull()).distinct()
        tagged = tagged.join(keys, F.col(link.column) == F.col(mark), "left")
        rules.append((link.reason, F.col(link.column).isNotNull() & F.col(mark).isNull()))
        marks.append(mark)
    return tag_violations(tagged, rules).drop(*marks)


def tag_repeated_emails(customers: DataFrame, arrival: list[str]) -> DataFrame:
    """Append ``duplicate_email`` where an earlier customer has the same address. NULL never repeats."""
    with_mark = tag_first(customers, ["email"], arrival, flag="_first_email", among=F.col("email").isNotNull())
    rule = ("duplicate_email", F.col("email").isNotNull() & ~F.col("_first_email"))
    return tag_violations(with_mark, [rule]).drop("_first_email")


def with_defaults(df: DataFrame, table: str, now: Column | None = None) -> DataFrame:
    """Fill absent or NULL columns with the defaults of ``table``."""
    now = F.localtimestamp() if now is None else now
    defaults = {
        "customers": {"created_at": now, "updated_at": now},
        "products": {"stock_quantity": F.lit(0), "created_at": now, "updated_at": now},
        "stores": {"created_at": now},
        "orders": {"tax_amount": F.lit(0).cast("decimal(12,2)"), "is_first_order": F.lit(False), "ingested_at": now},
    }[table]
    present = set(df.columns)
    return df.withColumns({
        name: F.coalesce(F.col(name), value) if name in present else value for name, value in defaults.items()
    })
