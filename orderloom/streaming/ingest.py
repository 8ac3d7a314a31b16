"""The ingest job: decode, clean, check and load each micro-batch, with every sink safe to repeat.

A micro-batch may run again after a crash, up to and including all of its writes. Rejects, touched dates and
metrics replace the partition named after the batch; orders are inserted if absent. An error anywhere fails the
batch, and the stream replays it: nothing is skipped."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators.absent import held_keys
from orderloom.operators.clean import Rule, rejected_orders, tag_orders, valid_orders
from orderloom.operators.constraints import mark_orphans, order_rules, orphan_keys
from orderloom.operators.dates import listed_dates
from orderloom.operators.firsts import later_copies, tag_listed
from orderloom.operators.sized import broadcast_if_small
from orderloom.plans.rollup import last_batch
from orderloom.schemas import BATCH_METRICS, CATEGORIES, FAILED_ATTEMPTS, ddl
from orderloom.sinks import keys
from orderloom.sinks.generations import fold_batches
from orderloom.sinks.warehouse import Warehouse
from orderloom.sources.events import decode, message_id, with_arrival, with_number, without_redelivery
from orderloom.streaming.totals import RunTotals, Totals, log_totals

_log = logging.getLogger(__name__)

# Poll interval of the live job and time limit of an hourly drain.
LIVE_TRIGGER = "1 second"
DRAIN_SECONDS = 300
# How long a drain waits for word of its own end, which another thread brings.
REPORT_SECONDS = 10


@dataclass(frozen=True)
class IngestOptions:
    """``dimensions`` names the master tables that orders must refer to. Orders that are stored already are found in
    the index of their ids. ``fixed_dates`` promises that copies of an order always carry the same order date; they are
    then looked for in the partitions of the orders that a batch falls in, and not in the index. ``redelivery`` is a
    time within which a message that comes again, text for text, is dropped before it is decoded: the bounded form of
    the search, for topics (not files) that are delivered at least once. Whatever passes is still looked for."""

    categories: Sequence[str] = CATEGORIES
    dimensions: Sequence[str] = ("customers", "products", "stores")
    fixed_dates: bool = False
    redelivery: str | None = None


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def load_batch(warehouse: Warehouse, messages: DataFrame, batch_id: int, label: str,
               options: IngestOptions = IngestOptions(), now: dt.datetime | None = None) -> dict[str, int]:
    """Process one micro-batch; ``label`` must be the same whenever this batch is repeated. Returns its counters, which
    are taken while the rejects are written; ``failed`` is the number of earlier attempts at it that ended in an error."""
    began = now or utc_now()
    kept: list[DataFrame] = []
    try:
        # Decoded once and laid down as columns, of which each step reads its own. Nothing wide is held in memory.
        raw = warehouse.stage(f"{label}/raw", decode(with_arrival(messages)))
        raw = raw.withColumn("_id", message_id(raw))
        decoded = F.col("payload").isNull()
        later = later_copies(with_number(raw), ["order_id"], "arrival", decoded, "_id").persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(later)
        marked = tag_listed(raw, broadcast_if_small(later), "_id", "_later").withColumn("_first", ~F.col("_later"))
        orphans: list[Rule] = []
        if options.dimensions:  # keys are stored as they came, so they are looked for in the text
            lost = {name: orphan_keys(raw, name, warehouse.read(name)).persist(StorageLevel.MEMORY_AND_DISK)
                    for name in options.dimensions}
            kept.extend(lost.values())
            marked, orphans = mark_orphans(marked, {name: broadcast_if_small(keys) for name, keys in lost.items()})
        tagged = tag_orders(marked, ["arrival"], options.categories, order_rules(), began, "_first", orphans)
        seen = Observation()
        watched = tagged.observe(seen, F.count(F.lit(1)).alias("consumed"),
                                 F.count_if(F.size("reject_reasons") > 0).alias("invalid"))
        warehouse.replace_partition("rejects", label, rejected_orders(watched))
        valid = warehouse.stage(f"{label}/valid", valid_orders(tagged).withColumns(
            {"ingest_batch": F.lit(label), "order_date": F.to_date("order_timestamp")}))
        held = _insert(warehouse, valid, label, options.fixed_dates)
        seq = last_batch(warehouse.read("touched_dates")) + 1
        touched = valid.select("order_date").distinct()
        warehouse.replace_partition("touched_dates", label, touched.withColumn("seq", F.lit(seq).cast("bigint")))
        counts = {name: int(seen.get[name]) for name in ("consumed", "invalid")}
        counts["inserted"] = counts["consumed"] - counts["invalid"] - held
        counts["failed"] = len(warehouse.files("failed_attempts", label))
        metrics = [(batch_id, counts["consumed"], counts["inserted"], counts["invalid"], counts["failed"],
                    now or utc_now(), label)]
        warehouse.replace_partition("batch_metrics", label, warehouse.spark.createDataFrame(metrics, ddl(BATCH_METRICS)))
        fold_batches(warehouse)
        return counts
    finally:
        for table in reversed(kept):
            table.unpersist()
        warehouse.drop_stage(label)


def _insert(warehouse: Warehouse, valid: DataFrame, label: str, fixed_dates: bool) -> int:
    """Append the orders that are not stored yet. Returns how many were stored before by other batches; those
    of an earlier attempt at this one are its own."""
    keys.recover(warehouse)
    dates = listed_dates(valid)
    stored = warehouse.read_partitions("orders", dates) if fixed_dates else keys.indexed(warehouse, valid)
    held = held_keys(valid, stored, ["order_id"], "ingest_batch").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        others = held.filter(F.col("ingest_batch") != label).select("order_id").distinct().count()
        known = broadcast_if_small(held.select("order_id"))
        fresh = valid.join(known, "order_id", "left_anti")
        written = Observation()
        keys.open_batch(warehouse, label, dates)
        warehouse.append("orders", fresh, written)
        if fixed_dates:  # the write drops what is cached of the orders, so what is fresh is told from the table
            keys.recover(warehouse)
        else:
            keys.add_keys(warehouse, valid.join(known, "order_id", "left_anti"), label, int(written.get["rows"]))
            keys.close_batch(warehouse, label)
        keys.fold_keys(warehouse)
        return others
    finally:
        held.unpersist()


def _note_failure(warehouse: Warehouse, label: str, error: Exception) -> None:
    """One row, in one file, for an attempt that ended in an error. The error itself matters more than its note."""
    try:
        row = [(utc_now(), f"{type(error).__name__}: {error}", label)]
        noted = warehouse.spark.createDataFrame(row, ddl(FAILED_ATTEMPTS))
        warehouse.append("failed_attempts", noted.coalesce(1))
    except Exception:
        _log.exception("the failure of batch %s could not be noted", label)


def batch_writer(warehouse: Warehouse, options: IngestOptions = IngestOptions(),
                 totals: RunTotals | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. Batches are labelled by the query id, which lives in the checkpoint. An error is
    noted and raised; a driver that is killed notes nothing."""
    def write(messages: DataFrame, batch_id: int) -> None:
        query = messages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        label = f"{query}-{batch_id}"
        try:
            counts = load_batch(warehouse, messages, batch_id, label, options)
        except Exception as error:
            _note_failure(warehouse, label, error)
            if totals:
                totals.add({"failed": 1})
            raise
        if totals:  # earlier attempts are of earlier runs
            totals.add({**counts, "failed": 0})

    return write


def _stream(messages: DataFrame, options: IngestOptions) -> DataFrame:
    return without_redelivery(messages, options.redelivery) if options.redelivery else messages


def _start(messages: DataFrame, warehouse: Warehouse, checkpoint: str, options: IngestOptions, trigger: dict,
           totals: RunTotals) -> StreamingQuery:
    writer = batch_writer(warehouse.create(), options, totals)
    return totals.watch(_stream(messages, options).writeStream.foreachBatch(writer)
                        .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_live(messages: DataFrame, warehouse: Warehouse, checkpoint: str, options: IngestOptions = IngestOptions(),
               trigger: str = LIVE_TRIGGER, report: Callable[[Totals], None] = log_totals) -> StreamingQuery:
    """Run until stopped; ``report`` is called with the run's totals then, whatever ended it. The checkpoint holds this
    job's position in the stream: one folder per job."""
    totals = RunTotals(warehouse.spark, report)
    return _start(messages, warehouse, checkpoint, options, {"processingTime": trigger}, totals)


def drain(messages: DataFrame, warehouse: Warehouse, checkpoint: str, options: IngestOptions = IngestOptions(),
          seconds: float | None = DRAIN_SECONDS, report: Callable[[Totals], None] = log_totals) -> bool:
    """Process what has arrived so far, then stop. Returns False when time ran out first; the rest, and a batch
    that was cut off, are left to the next run. ``report`` gets the run's totals in both cases and after an error."""
    totals = RunTotals(warehouse.spark, report)
    query = _start(messages, warehouse, checkpoint, options, {"availableNow": True}, totals)
    try:
        if seconds is None:
            query.awaitTermination()
            return True
        finished = query.awaitTermination(seconds)
        if not finished:
            query.stop()
        return bool(finished)
    finally:
        totals.ended.wait(REPORT_SECONDS)


def ingest_totals(metrics: DataFrame) -> DataFrame:
    """Sums over all batches and the share of consumed messages that were stored, in percent."""
    sums = {name: F.coalesce(F.sum(name), F.lit(0)) for name in ("consumed", "inserted", "invalid", "failed")}
    rate = F.coalesce(F.try_divide(F.sum("inserted") * 100.0, F.sum("consumed")), F.lit(0.0))
    return metrics.agg(*(total.alias(name) for name, total in sums.items()), rate.alias("success_rate"))
