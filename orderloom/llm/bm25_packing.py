"""Packing by lexical retrieval.

Documents are tokenized, dealt by similarity (two minimum hashes of their token sets, then id) and taken in shards of
bounded size. Each shard has its own BM25 inverted index over token ids. A seed document opens a window; the index
returns its unused neighbours by score, which fill the window greedily while they fit whole; what then is left open
takes the first part of the best remaining one, whose rest is the next seed. So windows are full; the last tokens of a
shard are laid in windows of powers of two, which need no padding."""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import SLICE_BYTES, mixed, settle, span_hashes, table, text_bytes, text_slices, to_int64

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END = 1
#: Tokens that one index holds, and how many of a seed's terms ask it.
SHARD_TOKENS, QUERY_TERMS = 1 << 20, 16
K1, B = 1.2, 0.75
#: Parts of words, and their ids, that a worker remembers.
REMEMBERED, REMEMBERED_IDS = 1_500_000, 8_000_000
#: New runs that are encoded in one line.
TOGETHER = 64
#: Neighbours that are ranked first; the others only if these don't fill the window.
FIRST = 48
_MARK, _LETTER, _DIGIT, _ODD, _SPACE = range(5)
_KINDS = np.full(256, _MARK, dtype=np.uint8)
_KINDS[128:] = _KINDS[ord("'")] = _ODD
_KINDS[list(string.ascii_letters.encode())] = _LETTER
_KINDS[list(string.digits.encode())] = _DIGIT
_KINDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_SPACES = _KINDS == _SPACE
_SMALL = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)


class WordTokenizer:
    """Ids of texts by a tokenizer that parts at white space, then into runs of letters, single digits and runs of marks.

    Texts are parted here as far as that is plain: a word of ASCII without an apostrophe into its runs; any other word
    stays whole, but for ASCII marks behind an ASCII letter or digit at its end, which are a run of their own whatever
    stands before. Runs of ASCII letters have the ids of their small forms. Parts are told by 64-bit hashes; those met before are
    answered from a bounded table, new ones go to the library, runs many at a time in one line."""

    def __init__(self, body: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_str(body)
        self.model.encode_special_tokens = True
        # Small runs of ASCII have nothing left to normalize or to part.
        plain = json.loads(body) | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}
        self.runs = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        #: Ids that end a run of letters, digits or marks; none, if the vocabulary doesn't tell.
        self.last = np.zeros(max(self.model.get_vocab_size(), END + 1), dtype=bool)
        self.last[[number for piece, number in vocabulary.items() if piece.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.held = np.zeros(0, dtype=np.uint32)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.texts_ids(pa.array([text], pa.string()))[0][:-1].astype("<u4").tobytes()

    def texts_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each text's followed by the end mark, and where each text's begin and the last ends."""
        data, offsets = text_bytes(texts)
        parts, sizes = [], np.zeros(len(texts), dtype=np.int64)
        for a, b in _stretches(data, offsets):
            inner = np.clip(offsets, a, b) - a
            found, counts = self._parts_ids(data[a:b], inner)
            parts.append(found)
            sizes += counts
        bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = np.empty(bounds[-1], dtype=np.uint32)
        inside = np.ones(len(out), dtype=bool)
        inside[bounds[1:] - 1] = False
        out[inside] = np.concatenate([np.zeros(0, dtype=np.uint32), *parts])
        out[bounds[1:] - 1] = END
        return out, bounds

    def _parts_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of concatenated texts, and how many each has."""
        data, starts, ends, whole = word_parts(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets) - 1, dtype=np.int64)
        hashes, example, number = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(hashes) > REMEMBERED or len(self.held) > REMEMBERED_IDS:
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == hashes[known]
        if not known.all():
            new, body = example[~known], data.tobytes()
            self._learn(hashes[~known], [body[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())], whole[new])
            at = np.searchsorted(self.keys, hashes)
        count = self.count[at][number]
        stops = np.cumsum(count)
        ids = self.held[np.repeat(self.first[at][number] - stops + count, count) + np.arange(stops[-1])]
        stops = np.concatenate([[0], stops])
        return ids, np.diff(stops[np.searchsorted(starts, offsets)])

    def _learn(self, hashes: np.ndarray, parts: list[bytes], whole: np.ndarray) -> None:
        texts = [part.decode() for part in parts]
        first, count = np.zeros(len(texts), dtype=np.int64), np.full(len(texts), -1)
        held, end = [self.held], len(self.held)
        plain = np.flatnonzero(~whole).tolist()
        words = [i for i in np.flatnonzero(whole).tolist() if texts[i].isalpha()]
        for model, runs in ((self.runs, plain), (self.model, words)):
            some = [runs[a:a + TOGETHER] for a in range(0, len(runs), TOGETHER)]
            lines = model.encode_batch_fast([" ".join([texts[i] for i in x]) for x in some], add_special_tokens=False)
            for mine, line in zip(some, lines):
                line = np.array(line.ids, dtype=np.uint32)
                ends = np.flatnonzero(self.last[line]) + 1
                if len(ends) == len(mine) and ends[-1] == len(line):  # one run each, as expected
                    first[mine] = end + np.concatenate([[0], ends[:-1]])
                    count[mine] = np.diff(ends, prepend=0)
                    held.append(line)
                    end += len(line)
        rest = np.flatnonzero(count < 0).tolist()
        for i, encoded in zip(rest, self.model.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            held.append(np.array(encoded.ids, dtype=np.uint32))
            first[i], count[i] = end, len(held[-1])
            end += count[i]
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.first, self.count = np.concatenate([self.first, first])[order], np.concatenate([self.count, count])[order]
        self.held = np.concatenate(held)


def _stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about ``SLICE_BYTES`` that end at white space or with a text."""
    a = 0
    while a < len(data):
        b = min(a + SLICE_BYTES, len(data))
        while b < len(data) and not _SPACES[data[b - 1]]:
            later = np.flatnonzero(_SPACES[data[b:b + SLICE_BYTES]])
            text_end = offsets[np.searchsorted(offsets, b)]
            b = min(int(text_end), b + (int(later[0]) + 1 if len(later) else SLICE_BYTES), len(data))
            if b == text_end:
                break
        yield a, b
        a = b


def word_parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, small in words that are parted; first byte of each part of the texts' words and the byte behind its
    last; and whether it is a word kept whole. In those a capital may compose with the mark behind it otherwise than its
    small form, so their letters stay as they are."""
    kind = _KINDS[data]
    inside = np.flatnonzero(kind != _SPACE)
    if not len(inside):
        return data, inside, inside, np.zeros(0, dtype=bool)
    kind = kind[inside]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    opens = np.concatenate([[True], (np.diff(inside) > 1) | cut[inside[1:]]])
    words = np.flatnonzero(opens)
    sizes = np.diff(np.concatenate([words, [len(inside)]]))
    odd = np.add.reduceat((kind == _ODD).astype(np.int64), words) > 0
    changes = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)])
    plain = ~np.repeat(odd, sizes)
    part = opens | (changes & plain)
    small = data.copy()
    small[inside[plain]] = _SMALL[data[inside[plain]]]
    kept = words[odd]
    core = np.maximum.reduceat(np.where(kind != _MARK, np.arange(len(kind)), -1), words)[odd]  # the last byte but marks
    marks = core + 1
    parted = (marks < kept + sizes[odd]) & (kind[core] != _ODD)
    part[marks[parted]] = True
    at = np.flatnonzero(part)
    whole = np.zeros(len(kind), dtype=bool)
    whole[kept] = True
    return small, inside[at], inside[np.concatenate([at[1:], [len(inside)]]) - 1] + 1, whole[at]


_TOKENIZERS: dict[int, WordTokenizer] = {}


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, near1, near2, ids): every text's ids with the end mark; near1, near2: minimum hashes of the id set."""
    with open(vocabulary, encoding="utf-8") as file:
        body = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        own = _TOKENIZERS.get(hash(body.value))
        if own is None:
            _TOKENIZERS.clear()
            own = _TOKENIZERS[hash(body.value)] = WordTokenizer(body.value)
        numbers = np.arange(max(own.model.get_vocab_size(), END + 1), dtype=np.uint64)
        hash1, hash2 = (to_int64(mixed(numbers + np.uint64(c)) >> np.uint64(1)) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
        for batch in batches:
            for part in text_slices(batch):
                ids, bounds = own.texts_ids(part.column("text"))
                near = [pa.array(np.minimum.reduceat(h[ids], bounds[:-1])) for h in (hash1, hash2)]
                laid = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), part.num_rows, [None, pa.py_buffer(4 * bounds), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *near, laid.cast(pa.binary())],
                                                 names=["doc_id", "near1", "near2", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, near1 long, near2 long, ids binary")


class Index:
    """BM25 inverted index of one shard's documents: postings by term, scored beforehand."""

    def __init__(self, documents: list[np.ndarray]):
        terms, counts, owners = [], [], []
        for d, ids in enumerate(documents):
            t, c = np.unique(ids[ids != END], return_counts=True)
            terms.append(t)
            counts.append(c)
            owners.append(np.full(len(t), d))
        term, tf, owner = np.concatenate(terms), np.concatenate(counts).astype(float), np.concatenate(owners)
        self.size = len(documents)
        lengths = np.array([len(x) for x in documents], dtype=float)
        self.terms, inverse, df = np.unique(term, return_inverse=True, return_counts=True)
        idf = np.log(1 + (self.size - df + 0.5) / (df + 0.5))
        weight = idf[inverse] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[owner] / max(lengths.mean(), 1.0)))
        order = np.argsort(inverse, kind="stable")
        self.docs, self.weights = owner[order], weight[order]
        self.starts = np.concatenate([[0], np.cumsum(df)])
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
        self.numbers, self.own, self.df = inverse, weight, df

    def scores(self, seed: int) -> np.ndarray:
        """Every document's score for the seed's most telling terms (those that others share, by weight)."""
        a, b = self.bounds[seed], self.bounds[seed + 1]
        number, weight = self.numbers[a:b], self.own[a:b]
        shared = self.df[number] > 1
        number, weight = number[shared], weight[shared]
        if len(number) > QUERY_TERMS:
            number = number[np.argpartition(-weight, QUERY_TERMS)[:QUERY_TERMS]]
        if not len(number):
            return np.zeros(self.size)
        runs = [slice(self.starts[t], self.starts[t + 1]) for t in number]
        return np.bincount(np.concatenate([self.docs[r] for r in runs]),
                           weights=np.concatenate([self.weights[r] for r in runs]), minlength=self.size)


def pack(documents: list[np.ndarray], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length): every id in exactly one piece, all sequences ``window`` long but
    the last few, whose lengths are powers of two."""
    sequences: list[list[tuple[int, int, int]]] = []
    start = np.zeros(len(documents), dtype=np.int64)
    sizes = np.array([len(x) for x in documents], dtype=np.int64)
    for d, size in enumerate(sizes):
        whole = size // window
        sequences += [[(d, k * window, window)] for k in range(whole)]
        start[d] = whole * window
    left = sizes - start
    unused = left > 0
    index = Index(documents)
    current: list[tuple[int, int, int]] = []
    seed, cursor, room = -1, 0, window

    def take(d: int, n: int) -> None:
        nonlocal room
        current.append((d, int(start[d]), int(n)))
        start[d] += n
        left[d] -= n
        room -= n

    def fill(candidates: np.ndarray) -> None:
        for d in candidates[left[candidates] <= room]:
            if left[d] <= room:
                unused[d] = False
                take(d, left[d])
                if not room:
                    break

    while True:
        if seed < 0:
            while cursor < len(documents) and not unused[cursor]:
                cursor += 1
            if cursor == len(documents):
                break
            seed = cursor
        unused[seed] = False
        take(seed, min(room, left[seed]))
        if room:
            scores = np.where(unused, index.scores(seed), -1.0)
            found = np.flatnonzero(scores > 0)
            best = found
            if len(found) > 2 * FIRST:
                best = found[np.argpartition(-scores[found], FIRST)[:FIRST]]
            best = best[np.argsort(-scores[best], kind="stable")]
            fill(best)
            if room and len(best) < len(found):
                best = found[np.argsort(-scores[found], kind="stable")]
                fill(best[unused[best]])
            if room:  # cut the best remaining neighbour, or the next document; its rest seeds the next window
                rest = best[unused[best]]
                if len(rest):
                    seed = int(rest[0])
                else:
                    while cursor < len(documents) and not unused[cursor]:
                        cursor += 1
                    if cursor == len(documents):
                        break
                    seed = cursor
                continue
        sequences.append(current)
        current, room = [], window
        if not left[seed]:
            seed = -1
    total, pieces = sum(n for _, _, n in current), iter(current)
    piece = next(pieces, None)
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        part: list[tuple[int, int, int]] = []
        while room:
            d, at, n = piece
            taken = min(n, room)
            part.append((d, at, taken))
            room -= taken
            piece = (d, at + taken, n - taken) if n > taken else next(pieces, None)
        if part:
            sequences.append(part)
    return sequences


_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece of each row of ``docs``
    (doc_id, text; others are ignored).

    A null text counts as empty: its only token is the end mark. Very long texts fill windows of their own, their rest
    is packed like a document. Repeated rows are documents of their own; a null doc_id stays null. An empty table gives
    an empty result."""
    rows = settle(tokenized(docs, vocabulary), "tokens")

    def run(batches):
        number, names, ids, size = TaskContext.get().partitionId() << 40, [], [], 0

        def flush():
            nonlocal number
            out = []
            for pieces in pack(ids, window):
                offset = 0
                for d, at, n in pieces:
                    crc = zlib.crc32(ids[d][at:at + n].tobytes())
                    out.append((names[d], at, n, crc, len(ids[d]), number, offset))
                    offset += n
                number += 1
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=[x.split()[0] for x in _SCHEMA.split(", ")])

        for batch in batches:
            for name, body in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                names.append(name)
                ids.append(np.frombuffer(body.as_py(), dtype="<u4"))
                size += len(ids[-1])
                if size >= SHARD_TOKENS:
                    yield flush()
                    names, ids, size = [], [], 0
        if ids:
            yield flush()

    near = ("near1", "near2", "doc_id")
    return rows.repartitionByRange(*near).sortWithinPartitions(*near).select("doc_id", "ids").mapInArrow(run, _SCHEMA)


def op5_bm25_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
