"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size says how often each of its documents is taken: the whole part always, the rest as an
inclusion probability. Those probabilities are moved within the unit cube along the null space of two balancing
constraints, tokens and documents, until each is 0 or 1 (flight phase). A step goes along the part of the longest
undecided document's axis that lies in the null space, to one face of the cube or the opposite one, at odds that keep
every expectation, so it decides at least one document; the longest are decided while there are many others to make up
for them.

Documents are dealt into chunks of bounded size by a hash of their own values, and chunks fly side by side; what a chunk
leaves undecided, two documents at most, meets what its neighbours left, and so on. A source's first chunk waits and
flies last, with what all others left: documents too long for their own chunk are decided while it makes up for them.
The two documents that are then left are the landing problem: the constraint on documents is given up first, then that
on tokens. Equal input gives equal draws, however it is laid out in files."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.llm.common import settle, table
from orderloom.operators.sized import broadcast_if_small

#: Weights of sources by code point, in turn; share of all sizes to take; times that a source is taken at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Documents of one chunk, about; and chunks of one level whose rests meet in one of the next.
CHUNK, MEET = 4096, 1024
#: Rows of equal values that are numbered by one row of an explode.
COPIES = 4096
_WORD = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_NEAR = 1e-9


def word_count(text):
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, _WORD))).otherwise(0).cast("bigint")


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(number, source, documents, source_size, target): one row per source of ``rows`` (source, size, copies), settled.

    ``share`` of all sizes is dealt by weight; no target is above ``most`` times its source's size, and what is cut off
    is dealt among the others by weight until none is above. That leaves every other source with one common multiple of
    its weight: the sources by how soon they are full, it is the first multiple that fills none of those still open."""
    sources = rows.groupBy("source").agg(
        F.sum("copies").alias("documents"), F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    sources = sources.withColumn("number", F.row_number().over(by_name) - 1)
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod("number", F.lit(len(weights))) + 1)
    sources = sources.withColumn("weight", turn).withColumn("cap", F.col("source_size") * float(most))
    everything = Window.partitionBy(F.lit(0))
    fuller = everything.orderBy(F.col("cap") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(fuller), F.lit(0.0))
    weighing = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fuller), F.lit(0.0))
    sources = sources.withColumn("level", left / weighing)
    keeps = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "number", "level"))
    level = F.min(keeps).over(everything)
    return settle(sources.select("number", "source", "documents", "source_size",
                                 F.least("cap", F.col("weight") * level["level"]).alias("target")), "sources")


class Draws:
    """Numbers in [0, 1), the same for the same name."""

    def __init__(self, *name):
        self.name, self.held, self.at = "/".join(map(str, name)).encode(), b"", 0

    def next(self) -> float:
        if not len(self.held):
            self.held = hashlib.shake_128(self.name + b"#%d" % self.at).digest(4096)
            self.at += 1
        head, self.held = self.held[:8], self.held[8:]
        return (int.from_bytes(head, "little") >> 11) / (1 << 53)


def _direction(sizes: np.ndarray) -> np.ndarray | None:
    """A direction that changes neither the number of documents nor that of their tokens, or None: what is left of the
    first document's own axis, so it moves most and all others make up for it a little each. Where that is next to
    nothing, the one direction that the last three have."""
    m = len(sizes)
    off = sizes - sizes.mean()
    spread = off @ off
    move = np.full(m, -1.0 / m)
    move[0] += 1
    if spread:
        move -= off * (off[0] / spread)
    if m > 3 and move[0] > 1e-6:
        return move
    if m < 3:
        return np.array([1.0, -1.0]) if m == 2 and sizes[0] == sizes[1] else None
    a, b, c = sizes[-3:]
    across = np.array([b - c, c - a, a - b])  # at right angles to (1, 1, 1) and to the sizes
    longest = np.abs(across).max()
    move[:] = 0
    move[-3:] = across / longest if longest else (1.0, -1.0, 0.0)
    return move


def _moved(chance: np.ndarray, move: np.ndarray, draws: Draws) -> np.ndarray:
    """``chance`` moved to one face of the cube or the opposite one, at odds that keep its mean."""
    pace = np.where(move == 0, 1.0, np.abs(move))
    ahead, behind = np.where(move > 0, 1 - chance, chance) / pace, np.where(move > 0, chance, 1 - chance) / pace
    forth, back = (np.where(move == 0, np.inf, x).min() for x in (ahead, behind))
    by = forth if draws.next() * (forth + back) < back else -back
    out = chance + by * move
    out[out < _NEAR] = 0.0
    out[out > 1 - _NEAR] = 1.0
    return out


def flight(sizes: np.ndarray, chances: np.ndarray, draws: Draws, land: bool = False) -> np.ndarray:
    """Chances moved until at most two are undecided, or none if ``land``; their sum, and their sum times sizes, stay as
    they are until the landing. Documents are decided in the order given, as far as there is a choice."""
    out = chances.astype(np.float64)
    live = np.flatnonzero((out > 0) & (out < 1))
    own = sizes[live].astype(np.float64)
    while len(live):
        move = _direction(own)
        if move is None:
            if not land:
                break
            # Without the constraint on documents; the last one without that on tokens too.
            move = np.array([own[1], -own[0]]) / own.max() if len(live) == 2 else np.ones(1)
        chance = _moved(out[live], move, draws)
        out[live] = chance
        rest = (chance > 0) & (chance < 1)
        live, own = live[rest], own[rest]
    return out


def _flown(land: bool):
    def run(key, group):
        group = group.sort_by([("size", "descending"), ("draw", "ascending"), ("copy", "ascending")])
        name = [x.as_py() for x in key]
        chance = flight(group.column("size").to_numpy(), group.column("chance").to_numpy(), Draws(*name), land)
        return group.set_column(group.schema.get_field_index("chance"), "chance", pa.array(chance, pa.float64()))
    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """A row for each of ``copies`` equal ones, told apart by ``copy``; by two explodes, so no array grows long."""
    blocks = rows.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    return blocks.withColumn("copy", F.explode(F.expr(
        f"sequence(block * {COPIES}, least(copies, (block + 1) * {COPIES}) - 1)"))).drop("block", "copies")


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken): a row for each row of ``docs`` (doc_id, text, source; others are
    ignored).

    A null text has no words; a document without words counts among the documents and takes 0. A null source is a source
    of its own, the last. Rows of equal id, source and size are told apart by a running number, so repeated rows are
    drawn each by itself, null ids too. An empty table gives an empty result, and where no text has a word all targets
    are 0."""
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        word_count(F.col("text").cast("string")).alias("size"))
    rows = settle(given.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    sources = source_targets(rows, weights, share, most)
    largest = sources.agg(F.max("documents")).first()[0] or 0
    often = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per_source = broadcast_if_small(sources.select(
        "number", F.col("source").alias("of"), F.ceil(F.col("documents") / CHUNK).alias("chunks"), (often - F.floor(often)).alias("chance")))
    units = _numbered(rows.join(per_source, F.col("source").eqNullSafe(F.col("of"))))
    draw = F.xxhash64("doc_id", "number", "size", "copy")
    units = units.select("number", F.pmod(draw, "chunks").alias("chunk"), "doc_id", "size", "chance", draw.alias("draw"), "copy")
    decided, open_ = units.where("chance <= 0"), units.where("chance > 0")
    first, open_ = open_.where("chunk = 0"), open_.where("chunk > 0")
    chunks = -(-largest // CHUNK)
    while chunks > 1:
        flown = settle(open_.groupBy("number", "chunk").applyInArrow(_flown(land=False), units.schema), "flown")
        decided = decided.union(flown.where("chance in (0, 1)"))
        open_ = flown.where("chance not in (0, 1)").withColumn("chunk", F.expr(f"chunk div {MEET}"))
        chunks = -(-chunks // MEET)
    last = first.union(open_.withColumn("chunk", F.lit(0).cast("bigint")))
    decided = decided.union(settle(last.groupBy("number", "chunk").applyInArrow(_flown(land=True), units.schema), "flown"))
    taken = (F.floor(often) + F.col("chance")).cast("bigint") * F.col("size")
    return decided.join(broadcast_if_small(sources), "number").select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"))


def op12_cube_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
