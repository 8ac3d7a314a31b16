"""Fill-in-the-middle texts, cut at unit borders found through a Fenwick tree.

A unit is a run of ASCII letters or any other single code point. A text is cut into blocks of ``BLOCK`` bytes; a Fenwick
tree over the blocks holds how many units and how many code points begin in each. A cut in front of unit k is found by
binary lifting: the descent passes whole blocks while their units fit into k and adds up their code points on the way;
only the block that it ends in is looked at byte by byte. So a text's flags are never held at once, however long it is.
The hashes that choose cuts and forms, the moved texts and the way back are Spark columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import table, text_bytes

BLOCK = 1024
#: Bytes whose flags are made at once while blocks are counted.
COUNTED = 1 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are moved, and of 100 moved ones so many begin with the suffix.
MOVED, SUFFIX_FIRST = 90, 20
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[ord("A"):ord("Z") + 1] = _LETTERS[ord("a"):ord("z") + 1] = True


def beginnings(data: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """For the bytes from ``start`` to ``end``: whether a unit begins there, and whether a code point does."""
    part = data[start:end]
    points = (part & 0xC0) != 0x80
    letters = _LETTERS[part]
    within = letters.copy()
    within[1:] &= letters[:-1]
    if start and len(part):
        within[0] &= _LETTERS[data[start - 1]]
    elif len(part):
        within[0] = False
    return points & ~within, points


def fenwick(counts: np.ndarray) -> np.ndarray:
    """Tree whose entry i, from 1, is the sum of the ``i & -i`` counts that end with the i-th."""
    sums = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(sums))
    return sums - sums[place - (place & -place)]


class BlockTree:
    """Counts of units and code points of one text's UTF-8 bytes."""

    def __init__(self, data: np.ndarray):
        self.data, self.blocks = data, -(-len(data) // BLOCK)
        units, points = (np.zeros(self.blocks, dtype=np.int64) for _ in range(2))
        for start in range(0, len(data), COUNTED):
            end = min(start + COUNTED, len(data))
            cuts = np.arange(0, end - start, BLOCK)
            for counts, flags in zip((units, points), beginnings(data, start, end)):
                counts[start // BLOCK:start // BLOCK + len(cuts)] = np.add.reduceat(flags.astype(np.int64), cuts)
        self.total = int(units.sum())
        self.units, self.points = fenwick(units), fenwick(points)

    def points_before(self, unit: int) -> int:
        """Code points in front of the unit of that number, from 0; of the whole text for the number of units."""
        at, before, step = 0, 0, 1 << self.blocks.bit_length()
        while step:
            if at + step <= self.blocks and self.units[at + step] <= unit:
                at += step
                unit -= int(self.units[at])
                before += int(self.points[at])
            step >>= 1
        if at == self.blocks:
            return before
        units, points = beginnings(self.data, at * BLOCK, min((at + 1) * BLOCK, len(self.data)))
        return before + int(np.count_nonzero(points[:np.flatnonzero(units)[unit]]))


def _cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    data, offsets = text_bytes(text)
    found = np.zeros((3, len(text)), dtype=np.int64)
    for i, (a, b) in enumerate(zip(one.to_pylist(), two.to_pylist())):
        tree = BlockTree(data[offsets[i]:offsets[i + 1]])
        units = a % (tree.total + 1), b % (tree.total + 1)
        found[:, i] = tree.total, tree.points_before(min(units)), tree.points_before(max(units))
    return pa.StructArray.from_arrays([pa.array(x) for x in found], ["n", "first", "second"])


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 from the hash of the seed and the id; a null id counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text that was moved, from the moved one and its form. A moved text holds each mark exactly once."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def fill_in_middle(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), seed: int = 1) -> DataFrame:
    """The columns ``keep`` with n, form, prefix_chars, middle_chars and output, a row for each row of ``docs`` (doc_id,
    text; others are ignored unless kept; kept ones must not have these five names).

    n is the number of units. A null text counts as empty; an empty one, or one that holds a mark, stays plain. A null
    doc_id draws like an empty text. Repeated rows are moved alike. An empty table gives an empty result. Texts are cut
    whole, whatever their length; the cuts of a text need its bytes and 32 more for each ``BLOCK`` of them."""
    cuts = F.arrow_udf(_cuts, "n long, first long, second long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*keep).alias("kept"), text.alias("text"), *(
        h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id"), seed), 1)))
    rows = rows.withColumn("cut", cuts("text", "h1", "h2"))
    own = F.col("text")
    plain = (own == "") | own.contains(PREFIX) | own.contains(SUFFIX) | own.contains(MIDDLE) | (F.col("h3") % 100 >= MOVED)
    first, second = (F.col(f"cut.{x}").cast("int") for x in ("first", "second"))
    form = F.when(plain, "plain").when(F.col("h4") % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    rows = rows.select("kept", "text", F.col("cut.n").alias("n"), first.alias("first"), second.alias("second"), form.alias("form"))
    prefix = F.substring(own, F.lit(1), F.col("first"))
    middle = F.substring(own, F.col("first") + 1, F.col("second") - F.col("first"))
    suffix = F.substring(own, F.col("second") + 1, F.length(own) - F.col("second"))
    moved = F.col("form") != "plain"
    output = (F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(own))
    return rows.select("kept.*", "n", "form", F.when(moved, F.col("first")).cast("bigint").alias("prefix_chars"),
                       F.when(moved, F.col("second") - F.col("first")).cast("bigint").alias("middle_chars"),
                       output.alias("output"))


def op13_fenwick_middle(spark, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


#: The same by lists of all units.
ORACLE = """
with units as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
           sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
drawn as (
    select *, cast(len(u) as bigint) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1,
           cast('0x' || substr(h, 9, 8) as bigint) as h2, cast('0x' || substr(h, 17, 8) as bigint) as h3,
           cast('0x' || substr(h, 25, 8) as bigint) as h4 from units),
formed as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
                then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
cut as (
    select doc_id, n, form, text, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m,
           array_to_string(u[b + 1:], '') as s from formed)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from cut"""
