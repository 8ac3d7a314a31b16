"""Helpers that the operators of this subpackage share: written intermediate tables, words and their hashes."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.session import shared_folder

#: Bytes of text that one step of vectorised work takes; a longer text is a step of its own.
SLICE_BYTES = 2 << 20
#: The same for work that makes a hundred bytes or more for each byte of text.
SMALL_SLICE_BYTES = 256 << 10
#: Bytes from which a span is hashed on its own.
LONG_SPAN = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def settle(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: lineage ends there, and a lost executor costs no rework."""
    spark, schema = rows.sparkSession, rows.schema
    path = shared_folder(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, as ``--py-files`` would. Spark's file server
    carries the archive, so the executors need no path of the driver's."""
    context = spark.sparkContext
    if getattr(context, "_orderloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "orderloom_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._orderloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0x632BE59BD9B4E019))
_POWERS: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = n + n // 8
        for k, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of text each, or one row."""
    texts = batch.column(column)
    if not len(texts):
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)]])
    for a, b in zip(starts[:-1], starts[1:]):
        yield batch.slice(int(a), int(b - a))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes one after the other, and where each begins and the last ends. Null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, of concatenated texts, and the index of
    each text's first word (and the last's end). Sums of byte codes times powers of an odd base, mixed."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return span_hashes(_LOWER[data], starts, ends), np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes. Sums of powers modulo 2^64 collide on some regular texts of 1,024 bytes (the
    Thue-Morse sequence and its complement, in any two letters), so long spans are hashed by BLAKE2 instead."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for k in np.flatnonzero(ends - starts >= LONG_SPAN):
        digest = hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest()
        hashes[k] = np.frombuffer(digest, dtype=np.uint64)[0]
    return hashes


def to_int64(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def components(links: DataFrame) -> DataFrame:
    """(node, component): each node of ``links`` (a, b) with the smallest node that it is connected to.

    Alternates two steps that hang neighbours on smaller nodes until nothing changes. All steps are joins and
    minima with map-side combine, so a node with very many links is no task of its own."""
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   "edges")
    tally = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))]
    told = edges.agg(*tally).first()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        nxt = settle(small.where("u <> v").distinct(), "edges")
        before, told = told, nxt.agg(*tally).first()
        if before == told:
            stars = nxt
            break
        edges = nxt
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
