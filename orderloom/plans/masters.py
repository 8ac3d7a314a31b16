"""Loads of master data: constraints, one unique key after the other, and what becomes of refused rows."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from orderloom.operators.absent import held_keys
from orderloom.operators.constraints import customer_rules, product_rules, split, store_rules, tag_violations
from orderloom.operators.firsts import keep_first, tag_first
from orderloom.sinks.warehouse import TABLES, Warehouse, insert_if_absent

KEYS = {"customers": "customer_id", "products": "product_id", "stores": "store_id"}
RULES = {"customers": customer_rules, "products": product_rules, "stores": store_rules}
# Further columns whose values no two rows of a table share. NULL never repeats.
UNIQUE = {"customers": ("email",)}


def load_master(warehouse: Warehouse, table: str, rows: DataFrame, arrival: list[str], label: str) -> int:
    """Add the rows that break no constraint and whose key the table lacks; returns their number. Refused ones become
    the partition ``label`` of ``master_rejects``, with their reasons.

    The key is settled first: the first copy of a load that breaks no rule speaks for its key, and a key that is stored
    stays as it is, silently. Then each unique column: a value that another stored row has, or an earlier row of this
    load, refuses the row (``duplicate_email``); a refused row takes no value. So the order of loads, and within one the
    arrival, decides who wins where both clash. Repeating a load adds nothing and refuses the same rows, but for those
    whose reason another load has brought or taken."""
    key, layout = KEYS[table], TABLES[table].layout
    given = rows.columns
    rows = rows.withColumns({name: F.lit(None).cast(kind) for name, kind in layout.items() if name not in given})
    good, bad = split(tag_violations(rows, RULES[table]()))
    stored = warehouse.read(table)
    first = keep_first(good, [key], arrival).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [first]
    try:
        tagged = first.join(held_keys(first, stored, [key]), key, "left_anti").withColumn(
            "reject_reasons", F.array().cast("array<string>"))
        for column in UNIQUE.get(table, ()):
            free = F.col(column).isNotNull() & (F.size("reject_reasons") == 0)
            taken = held_keys(first.filter(F.col(column).isNotNull()), stored, [column]).distinct()
            tagged = tagged.join(taken.withColumn("_taken", F.lit(True)), column, "left")
            tagged = tag_first(tagged, [column], arrival, flag="_first", among=free & F.col("_taken").isNull())
            tagged = tag_violations(tagged, [(f"duplicate_{column}", free & ~F.col("_first"))]).drop("_taken", "_first")
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(tagged)
        accepted, repeated = split(tagged)
        refused = bad.unionByName(repeated.select(*bad.columns))
        warehouse.replace_partition("master_rejects", label, refused.select(
            F.lit(table).alias("table_name"), F.col(key).cast("string").alias("row_key"),
            F.col("reject_reasons")[0].alias("reject_reason"), "reject_reasons",
            F.to_json(F.struct(*given)).alias("row_json")))
        return insert_if_absent(warehouse, table, accepted, key, arrival)
    finally:
        for cached in reversed(kept):
            cached.unpersist()
