"""Byte-level BPE encoding and decoding with two tiers.

The text is cut into pre-tokens by the vocabulary's pattern. Tier one: a minimal perfect hash over the vocabulary
(buckets with displacement seeds, one slot per token) tells whether a whole pre-token is a token, and which. Tier two,
for the others: bytes in a linked list, candidate pairs in a heap by rank and place, merged until none is left. Chunks of
text that were met before are answered from a bounded memory. Texts stay whole; the vocabulary is broadcast, its size
is that of the file (some 50,000 tokens)."""

from __future__ import annotations

import base64
import re
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import table, text_slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Chunks and as many pre-tokens that one worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 600_000, 48
_MASK = (1 << 64) - 1
#: Before a space that follows something else than white space, pre-tokens always part.
_CUT = re.compile(r"(?<=\S)(?= )")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PerfectHash:
    """Minimal perfect hash of byte strings to 0..n-1: the hash's upper half picks a bucket, the bucket's seed a slot
    that no other key has; a bucket of one key names its slot directly."""

    def __init__(self, keys: list[bytes]):
        self.size, self.buckets = len(keys), max(1, len(keys) // 3)
        groups: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        if len(set(hashes)) != len(keys):
            raise ValueError("two tokens have one hash")
        for h in hashes:
            groups.setdefault((h >> 32) * self.buckets >> 32, []).append(h)
        self.seeds = [0] * self.buckets
        free = set(range(self.size))
        for bucket, group in sorted(groups.items(), key=lambda g: -len(g[1])):
            if len(group) == 1:
                self.seeds[bucket] = -1 - free.pop()
                continue
            seed = 1
            while True:
                slots = {self._slot(h, seed) for h in group}
                if len(slots) == len(group) and slots <= free:
                    break
                seed += 1
            free -= slots
            self.seeds[bucket] = seed

    def _slot(self, h: int, seed: int) -> int:
        return ((((h ^ (seed * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93) & _MASK) >> 32) * self.size >> 32

    def slot(self, key: bytes) -> int:
        """The key's slot, or that of some key if this one was not among the given."""
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[(h >> 32) * self.buckets >> 32]
        return -1 - seed if seed < 0 else self._slot(h, seed)


class Tables:
    """Vocabulary as the workers need it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.hash = PerfectHash(list(ranks))
        self.tokens: list[bytes] = [b""] * len(ranks)
        self.ids = [0] * len(ranks)
        self.names = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            slot = self.hash.slot(token)
            self.tokens[slot], self.ids[slot] = token, rank
            self.names[rank] = token


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of a pre-token by repeated merging of the pair of least rank, leftmost first."""
    n, rank = len(piece), ranks.get
    after, before, pending = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
    heap = []
    for i in range(n - 1):
        r = rank(piece[i:i + 2])
        if r is not None:
            pending[i] = r
            heap.append(r << 40 | i)
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFFFF
        if pending[i] != entry >> 40:
            continue
        j = after[i]
        end = after[j]
        after[i], pending[j], pending[i] = end, -1, -1
        if end < n:
            before[end] = i
            r = rank(piece[i:after[end]])
            if r is not None:
                pending[i] = r
                heappush(heap, r << 40 | i)
        left = before[i]
        if left >= 0:
            r = rank(piece[left:end])
            pending[left] = -1 if r is None else r
            if r is not None:
                heappush(heap, r << 40 | left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class Encoder:
    def __init__(self, tables: Tables):
        self.tables, self.split = tables, regex.compile(tables.pattern)
        self.seen: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        """Ids, as little-endian unsigned 32-bit integers, of text that pre-tokens don't cross at either end."""
        pieces = self.split.findall(chunk)
        found = list(map(self.pieces.get, pieces))
        for i, value in enumerate(found):
            if value is None:
                value = found[i] = self._piece(pieces[i].encode())
                if len(pieces[i]) <= LONGEST:
                    if len(self.pieces) >= REMEMBERED:
                        self.pieces.clear()
                    self.pieces[pieces[i]] = value
        return b"".join(found)

    def _piece(self, raw: bytes) -> bytes:
        known = self.tables
        slot = known.hash.slot(raw)
        if known.tokens[slot] == raw:
            return known.ids[slot].to_bytes(4, "little")
        return array("I", merge_pairs(raw, known.ranks)).tobytes()

    def encode(self, text: str) -> bytes:
        parts = text.split(" ")
        found = list(map(self.seen.get, parts))
        found[0] = b"" if parts[0][-1:].isspace() else self._chunk(parts[0])
        if None in found or not found[0]:
            for i, value in enumerate(found):
                if not value and (i or text[:1] != " "):
                    part = parts[i]
                    if not part or part[-1].isspace():  # white space of several characters, or at the end
                        return b"".join(map(self._chunk, _CUT.split(text)))
                    value = found[i] = self.seen.get(part) or self._chunk(" " + part)
                    if len(part) <= LONGEST:
                        if len(self.seen) >= REMEMBERED:
                            self.seen.clear()
                        self.seen[part] = value
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tables.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_ENCODERS: dict[int, Encoder] = {}


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` (doc_id, text; others are ignored) with ``ids``: the text's token ids as little-endian unsigned 32-bit
    integers, and ``decoded``: the bytes that they stand for.

    A null text is encoded as an empty one, which has no ids. Repeated rows come back as often as they came in, a null
    doc_id stays null, an empty table gives an empty result. ``vocabulary`` is a rank file that the driver reads."""
    tables = docs.sparkSession.sparkContext.broadcast(Tables(read_ranks(vocabulary), pattern))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        key = tables.value.hash.size, id(tables.value)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = Encoder(tables.value)
        encoder = _ENCODERS[key]
        for batch in batches:
            for part in text_slices(batch):
                ids = [encoder.encode(t) if t else b"" for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(encoder.decode, ids), pa.binary())],
                    names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        encode, f"doc_id {kind}, ids binary, decoded binary")


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
