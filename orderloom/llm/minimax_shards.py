"""Shards of nearly equal size: minimax contiguous partition of ordered atomic groups.

Rows with equal texts form one atomic group; groups are ordered by their smallest doc_id. The smallest feasible shard
capacity is searched by bisecting its range into many candidates at a time; a candidate is checked greedily, each
shard taking the longest run of groups that fits. A greedy step is one equi-join of the candidates' targets with the
running totals of groups, by blocks of the total. Groups that alone reach an equal share get shards of their own and
leave the order. All of it is DataFrame operations; the driver sees block summaries of fixed number only."""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from orderloom.llm.common import settle, table

BLOCKS = 4096
CANDIDATES = 1023
#: Slices of the range of doc_id by which rows of one group are numbered side by side.
SLICES = 1024


def listed(spark: SparkSession, values) -> DataFrame:
    """(pos, value): a few strings without commas as rows, planned as one literal."""
    return spark.range(1).select(F.posexplode(F.split(F.lit(",".join(values)), ",")).alias("pos", "value"))


class Totals:
    """Ends of groups along the order (cumulated bytes), looked up for many targets in one job."""

    def __init__(self, spark: SparkSession, ends: DataFrame, total: int):
        self.spark, self.total = spark, total
        self.width = max(1, -(-total // BLOCKS))
        self.ends = ends.select("end", F.expr(f"end div {self.width}L").alias("block")).persist()
        rows = self.ends.groupBy("block").agg(F.min("end").alias("low"), F.max("end").alias("high")).collect()
        self.low = {r["block"]: r["low"] for r in rows}
        self.high = {r["block"]: r["high"] for r in rows}
        self.blocks = sorted(self.low)

    def _within(self, targets: list[int], below: bool) -> dict[int, int]:
        known = listed(self.spark, map(str, sorted(set(targets)))).select(
            F.col("value").cast("bigint").alias("target"), F.expr(f"cast(value as bigint) div {self.width}L").alias("block"))
        fits = F.col("end") <= F.col("target") if below else F.col("end") >= F.col("target")
        best = F.max("end") if below else F.min("end")
        found = self.ends.join(F.broadcast(known), "block").where(fits).groupBy("target").agg(best.alias("end"))
        return {r["target"]: r["end"] for r in found.collect()}

    def below(self, targets: list[int]) -> list[int]:
        """Largest end (or 0) not above each target."""
        near = self._within(targets, True)
        out = []
        for t in targets:
            if t not in near:
                i = bisect.bisect_left(self.blocks, t // self.width)
                near[t] = self.high[self.blocks[i - 1]] if i else 0
            out.append(near[t])
        return out

    def above(self, target: int) -> int:
        """Smallest end not below the target; 0 if the target is 0 or less."""
        if target <= 0:
            return 0
        near = self._within([target], False)
        if target in near:
            return near[target]
        i = bisect.bisect_right(self.blocks, target // self.width)
        return self.low[self.blocks[i]] if i < len(self.blocks) else self.total

    def close(self) -> None:
        self.ends.unpersist()


def smallest_capacity(totals: Totals, shards: int, largest: int) -> int:
    """Smallest capacity with which ``shards`` greedy runs hold everything."""
    low = max(largest, -(-totals.total // shards))
    high = low + largest  # a shard that ends below its capacity lacks less than one group
    while low < high:
        step = max(1, -(-(high - low) // (CANDIDATES + 1)))
        tried = list(range(low, high, step))[:CANDIDATES]
        reached = [0] * len(tried)
        for _ in range(shards):
            reached = totals.below([r + c for r, c in zip(reached, tried)])
        fits = [c for c, r in zip(tried, reached) if r >= totals.total]
        if fits:
            high = fits[0]
        unfit = [c for c in tried if c < high]
        low = unfit[-1] + 1 if unfit else high
    return high


def cuts(totals: Totals, shards: int, largest: int) -> list[int]:
    """Ends of all shards but the last. With the smallest capacity known, each cut is the last end within it that does
    not pass an equal share, or the first that leaves the later shards able to hold the rest."""
    if not totals.total or shards < 2:
        return []
    capacity = smallest_capacity(totals, shards, largest)
    least = [totals.total] * (shards + 1)
    for k in range(shards - 1, 0, -1):
        least[k] = totals.above(least[k + 1] - capacity)
    found, at = [], 0
    for k in range(1, shards):
        fit = totals.below([min(at + capacity, totals.total * k // shards)])[0]
        at = max(least[k], fit, at)
        found.append(at)
    return found


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs`` (doc_id, text).

    Law ``bytes``: equal texts stay together, shards are runs of groups whose largest sum of sizes is as small as any
    contiguous cut allows. A null text has size 1 and the checksum of no bytes; null texts form one group, apart from
    empty ones. Repeated rows and a null doc_id (first in order) keep slots of their own. Empty table: empty result.
    ``grown_shard`` is null under this law."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    base = settle(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("none")).alias("key")), "sizes")
    span = base.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    width = max(1, ((span["b"] or 0) - (span["a"] or 0)) // SLICES + 1)
    base = base.withColumn("slice", F.coalesce(F.expr(f"(doc_id - {span['a'] or 0}L) div {width}L"), F.lit(-1)).cast("bigint"))
    slices = settle(base.groupBy("key", "slice").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
                                                     F.min("doc_id").alias("first")), "slices")
    groups = settle(slices.groupBy("key").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
                                              F.min("first").alias("first")), "groups")
    heavy, left, rest = [], shards, groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    for row in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        if left < 2 or row["bytes"] * left < rest or row["bytes"] == rest:
            break
        heavy.append(row["key"])
        rest, left = rest - row["bytes"], left - 1
    light = groups.where(~F.col("key").isin(heavy)) if heavy else groups
    parts = settle(light.repartitionByRange("first", "key").sortWithinPartitions("first", "key")
                   .withColumn("part", F.spark_partition_id()), "ordered")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("r")).select(  # one row a partition
        "part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b"), F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r"))
    upto = Window.partitionBy("part").orderBy("first", "key").rowsBetween(Window.unboundedPreceding, 0)
    ends = settle(parts.join(F.broadcast(offsets), "part").select(
        "key", (F.col("b") + F.sum("bytes").over(upto)).alias("end"),
        (F.col("r") + F.sum("rows").over(upto) - F.col("rows")).alias("rank")), "ends")
    totals = Totals(spark, ends, rest)
    largest = groups.where(~F.col("key").isin(heavy)).agg(F.max("bytes")).first()[0] if heavy else \
        groups.agg(F.max("bytes")).first()[0]
    bounds = cuts(totals, left, largest or 0)
    totals.close()
    shard = F.lit(0)
    for bound in bounds:
        shard = shard + (F.col("end") > bound).cast("int")
    placed = ends.withColumn("shard", shard)
    starts = placed.groupBy("shard").agg(F.min("rank").alias("start"))
    placed = placed.join(F.broadcast(starts), "shard").select("key", "shard", (F.col("rank") - F.col("start")).alias("rank"))
    if heavy:
        placed = placed.union(listed(spark, heavy).select(
            F.col("value").alias("key"), (F.col("pos") + left).alias("shard"), F.lit(0).cast("bigint").alias("rank")))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.join(placed, "key").select(
        "key", "slice", "shard", (F.col("rank") + F.coalesce(F.sum("rows").over(earlier), F.lit(0))).alias("rank"))
    within = Window.partitionBy("key", "slice").orderBy("doc_id")
    return base.join(slices, ["key", "slice"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") + F.row_number().over(within) - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op3_minimax_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
