"""The daily summary kept by adding: late orders are counted into their day without reading the day's other orders.

Sums add up, distinct customers don't. So beside the sums of each run lie the customers it met for the first time in a
day, category and region: a late order looks its customer up among those of its day, four narrow columns, and counts it
only if it is new. Exact, whatever order the batches come in.

A run writes one folder of sums (``deltas``), one of new customers and one of the batches it counted; then a notice, which
appears whole by a rename, puts all three in force at once. A run that is cut off before its notice is written again
under the same number, one that is cut off after it has its days published again by the next run. Folders are merged by
levels, ``FAN_IN`` to one, so that a row is rewritten as often as the number of runs has digits to that base.

A batch counts from the moment it has noted its dates, which is after its orders are stored. A batch that notes its
dates again, or that had orders in a day which was counted whole, makes its days be counted whole from then on:
``whole`` rows replace what earlier runs have of their day."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.calendar import Instant
from orderloom.operators.dates import listed_dates
from orderloom.operators.sized import broadcast_if_small
from orderloom.plans.rollup import last_batch, summary_keys, summary_measures, write_summary
from orderloom.schemas import MONEY, SUMMARY_KEYS, SUMMARY_MEASURES, ddl
from orderloom.sinks.warehouse import Warehouse

# Folders of a level that are merged into one of the next.
FAN_IN = 16
# Batches whose names are put into the scan's filter, and names to one condition: a longer list would be pushed down as
# its least and greatest only.
LISTED, CONDITION = 1000, 10

_SUMS = {name: kind for name, kind in SUMMARY_MEASURES.items() if name != "avg_order_value"} | {"priced_orders": "bigint"}
_LAYOUTS = {
    "deltas": {"category": "string", "region": "string", **_SUMS, "run": "bigint", "whole": "boolean", "summary_date": "date"},
    "customers": {"category": "string", "region": "string", "customer_id": "string", "run": "bigint", "summary_date": "date"},
    "batches": {"ingest_batch": "string", "seq": "bigint", "run": "bigint"},
}
_EMPTY = {"run": 0, "folders": [], "merged": [], "days": [], "through": 0}


class _Parts:
    """What the notice in force names."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.root = f"{warehouse.path('daily_summary')}_parts"
        self.names = set(warehouse.names(self.root))
        runs = [int(name[1:]) for name in self.names if name[0] == "n" and name[1:].isdecimal()]
        self.now = json.loads(warehouse.read_text(f"{self.root}/n{max(runs)}")) if runs else _EMPTY
        self.published = not runs or f"p{max(runs)}" in self.names

    def path(self, table: str, folder: str) -> str:
        return f"{self.root}/{table}/part={folder}"

    def read(self, table: str, folders: list[str] | None = None) -> DataFrame:
        spark, layout = self.warehouse.spark, _LAYOUTS[table]
        folders = self.now["folders"] if folders is None else folders
        if not folders:
            return spark.createDataFrame([], ddl(layout))
        paths = (self.path(table, name) for name in folders)
        return spark.read.schema(ddl(layout)).option("basePath", f"{self.root}/{table}").parquet(*paths).select(*layout)

    def write(self, table: str, folder: str, rows: DataFrame) -> None:
        writer = rows.select(*_LAYOUTS[table])
        if table == "batches":
            writer.write.mode("overwrite").parquet(self.path(table, folder))
        else:
            (writer.hint("rebalance", "summary_date").write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy("summary_date").parquet(self.path(table, folder)))

    def resets(self) -> DataFrame:
        """(reset_date, reset): the last run that counted a day whole. As many rows as days at most."""
        return (self.read("deltas").filter("whole").groupBy(F.col("summary_date").alias("reset_date"))
                .agg(F.max("run").alias("reset")))


def _in_force(rows: DataFrame, resets: DataFrame) -> DataFrame:
    """``rows`` without those that a later whole count of their day replaced."""
    held = rows.join(broadcast_if_small(resets), F.col("summary_date") == F.col("reset_date"), "left")
    return held.filter(F.col("run") >= F.coalesce("reset", F.lit(0))).drop("reset_date", "reset")


def _pending(touched: DataFrame, counted: DataFrame) -> DataFrame:
    counted = counted.select(F.col("ingest_batch").alias("old_batch"), F.col("seq").alias("old_seq"))
    return touched.join(counted, (F.col("ingest_batch") == F.col("old_batch")) & (F.col("seq") == F.col("old_seq")), "left_anti")


def pending_batches(warehouse: Warehouse) -> DataFrame:
    """(order_date, seq, ingest_batch) of the batches that :func:`merge_daily_summary` has yet to count."""
    return _pending(warehouse.read("touched_dates"), _Parts(warehouse).read("batches"))


def of_batches(orders: DataFrame, batches: DataFrame, listed: int = LISTED) -> DataFrame:
    """Orders that came in with ``batches``. Up to ``listed`` names become conditions, by which the scan passes over the
    files of all other batches; more are joined, to the same result."""
    names = batches.select("ingest_batch").distinct()
    found = sorted(row["ingest_batch"] for row in names.limit(listed + 1).collect())
    if len(found) > listed:
        return orders.join(broadcast_if_small(names), "ingest_batch", "left_semi")
    chunks = (F.col("ingest_batch").isin(found[at:at + CONDITION]) for at in range(0, len(found), CONDITION))
    return orders.filter(reduce(Column.__or__, chunks, F.lit(False)))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """A join on columns in which null equals null."""
    twins = right.select(*(F.col(name).alias(f"r_{name}") for name in names))
    matches = (F.col(name).eqNullSafe(F.col(f"r_{name}")) for name in names)
    return left.join(twins, reduce(Column.__and__, matches), how)


def _summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*SUMMARY_KEYS).agg(
        *(F.sum(name).cast(kind).alias(name) for name, kind in _SUMS.items()), F.max("whole").alias("whole"))


def _publish(parts: _Parts, computed_at: Instant) -> None:
    """Replace the days of the run in force in the summary table."""
    days = [dt.date.fromisoformat(day) for day in parts.now["days"]]
    sums = _summed(_in_force(parts.read("deltas").filter(F.col("summary_date").isin(days)), parts.resets()))
    mean = F.try_divide("total_revenue", F.col("priced_orders")).cast("decimal(16,6)")
    summary = sums.withColumns({
        "avg_order_value": F.round(mean, 2).cast(MONEY),
        "unique_customers": F.coalesce("unique_customers", F.lit(0)).cast("bigint")})
    write_summary(summary, parts.warehouse.path("daily_summary"), computed_at, parts.now["through"])
    parts.warehouse.write_text(f"{parts.root}/p{parts.now['run']}", "")


def merge_daily_summary(warehouse: Warehouse, computed_at: Instant = None, recount: Iterable[dt.date] = (),
                        fan_in: int = FAN_IN, **vocabulary: Sequence[str]) -> int:
    """Count the batches that are not counted yet into their days, and replace these days in the summary table.

    Days in ``recount`` are counted whole, also the orders of batches that were cut off before they noted their dates
    and never ran again. Returns the number of batches; without any, and without ``recount``, nothing is written.
    Call it instead of :func:`~orderloom.plans.rollup.upsert_daily_summary`, always with the same vocabulary, and one at
    a time: what that function writes of a day is replaced when the day's next batch is counted."""
    parts = _Parts(warehouse)
    if not parts.published:
        _publish(parts, computed_at)
    touched = warehouse.read("touched_dates")
    through = last_batch(touched)
    counted = parts.read("batches")
    pending = _pending(touched, counted).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [pending]
    try:
        number = pending.select("ingest_batch").distinct().count()
        again = pending.join(counted.select("ingest_batch"), "ingest_batch", "left_semi")
        whole = sorted({*listed_dates(again), *recount})
        days = sorted({*listed_dates(pending), *whole})
        if not days:
            return 0
        run = parts.now["run"] + 1
        orders = warehouse.read("orders")
        added = [day for day in days if day not in set(whole)]
        news = of_batches(orders.filter(F.col("order_date").isin(added)),
                          pending.join(counted.select("ingest_batch"), "ingest_batch", "left_anti"))
        counted_whole = orders.filter(F.col("order_date").isin(whole))
        news = news.select(*orders.columns).unionByName(counted_whole)
        resets = parts.resets()

        seen = (news.select(*summary_keys(), "customer_id").filter(F.col("customer_id").isNotNull()).distinct()
                .persist(StorageLevel.MEMORY_AND_DISK))
        kept.append(seen)
        who = [*SUMMARY_KEYS, "customer_id"]
        stored = _in_force(parts.read("customers").filter(F.col("summary_date").isin(added)), resets)
        held = _same(stored, broadcast_if_small(seen), who, "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(held)
        first = _same(seen, held, who, "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(first)

        measures = {name: how for name, how in summary_measures(**vocabulary).items() if name in _SUMS}
        measures = {**measures, "priced_orders": F.count("final_amount")}
        del measures["unique_customers"]
        sums = news.groupBy(*summary_keys()).agg(
            *(how.cast(_SUMS[name]).alias(name) for name, how in measures.items()))
        customers = first.groupBy(*SUMMARY_KEYS).agg(F.count(F.lit(1)).alias("unique_customers"))
        stray = (counted_whole.select("ingest_batch").distinct()
                 .join(touched.select("ingest_batch"), "ingest_batch", "left_anti").withColumn("seq", F.lit(0)))
        new = {"deltas": (sums.unionByName(customers, allowMissingColumns=True)
                          .withColumn("whole", F.col("summary_date").isin(whole))),
               "customers": first,
               "batches": pending.select("ingest_batch", "seq").distinct().unionByName(stray)}

        merged, level = [], 0
        while len(same := [name for name in parts.now["folders"] if name.endswith(f"l{level}")]) >= fan_in - 1:
            merged += same
            level += 1
        if merged:
            marks = warehouse.spark.createDataFrame([(day, run) for day in whole], "reset_date date, reset bigint")
            resets = resets.unionByName(marks).groupBy("reset_date").agg(F.max("reset").alias("reset"))
            for table in ("deltas", "customers"):
                new[table] = new[table].unionByName(
                    _in_force(parts.read(table, merged), resets).drop("run"), allowMissingColumns=True)
            new["batches"] = new["batches"].unionByName(parts.read("batches", merged).drop("run"))
        new["deltas"] = _summed(new["deltas"])
        folder = f"r{run}l{level}"
        for table, rows in new.items():
            parts.write(table, folder, rows.withColumn("run", F.lit(run).cast("bigint")))

        # What the last merge replaced has served the queries that were planned before it.
        for table in _LAYOUTS:
            for name in parts.now["merged"]:
                warehouse.drop_folder(parts.path(table, name))
        text = json.dumps({
            "run": run, "folders": [*(name for name in parts.now["folders"] if name not in merged), folder],
            "merged": merged, "days": [day.isoformat() for day in days], "through": through})
        warehouse.write_text(f"{parts.root}/n{run}", text)
        _publish(_Parts(warehouse), computed_at)
        warehouse.drop_files([f"{parts.root}/{name}" for name in sorted(parts.names)
                              if name[0] in "np" and name[1:].isdecimal() and int(name[1:]) < run - 1])
        return number
    finally:
        for rows in reversed(kept):
            rows.unpersist()
