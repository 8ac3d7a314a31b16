"""Language of words and texts by a linear-chain conditional random field.

Words are a chain, languages their labels. A word's features are its byte trigrams with the word's borders, prefixes
and suffixes of one to three bytes, and the languages in whose lexicon it stands; transitions between labels are
learned too. Training sequences are made of stretches of several labelled texts, so the model sees switches of language
within a sequence. It is fitted on the driver on a sample of at most ``SAMPLE`` labelled texts per language, of each a
stretch of ``SAMPLE_CHARS`` characters; whole texts of the whole table are then labelled in parallel by forward-backward. Long chains are taken in blocks whose transfer
matrices are multiplied side by side and then chained, which is exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import SMALL_SLICE_BYTES, mixed, table, text_bytes, text_slices, word_hashes
from orderloom.operators.sized import broadcast_if_small

#: Texts per language that the model is fitted on, and characters that each of them gives at most.
SAMPLE, SAMPLE_CHARS = 400, 4_000
#: Words of training sequences, and of one text's stretch within them at most.
CHAIN, STRETCHES, CHAINS = 24, 3, 6000
BITS = 17
LEXICON = 4000
BLOCK = 64
_U = np.uint64
_BORDER = 32
_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[:65] = ord(".")
_CLASSES[91:97] = ord(".")
_CLASSES[123:128] = ord(".")
_CLASSES[48:58] = ord("0")
_CLASSES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _BORDER
_CLASSES[ord("A"):ord("Z") + 1] += 32
_LETTER = r"\p{L}"
_TEXT = "text to label"


def _hashed(kind: int, code: np.ndarray) -> np.ndarray:
    return (mixed(code.astype(np.uint64) + _U(kind << 40)) >> _U(64 - BITS)).astype(np.int64)


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each word, as :func:`word_hashes` finds them."""
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    inside = _CLASSES[data] != _BORDER
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    return np.flatnonzero(inside & (~before | cut[:-1])), np.flatnonzero(inside & (~after | cut[1:]))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigrams of all bytes of words, first row of each word among them, affixes by word): numbers of weights."""
    starts, ends = word_places(data, offsets)
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros((0, 6), dtype=np.int64)
    codes = _CLASSES[data].astype(np.int64)
    left = np.concatenate([[_BORDER], codes[:-1]])
    right = np.concatenate([codes[1:], [_BORDER]])
    left[starts] = _BORDER
    right[ends] = _BORDER
    inside = np.flatnonzero(codes != _BORDER)
    grams = _hashed(1, (left[inside] << 16) | (codes[inside] << 8) | right[inside])
    first = np.searchsorted(inside, starts)
    size = ends - starts + 1
    affixes = np.zeros((len(starts), 6), dtype=np.int64)
    last = len(data) - 1
    head = tail = np.zeros(len(starts), dtype=np.int64)
    for k in range(3):
        head = (head << 8) | np.where(size > k, codes[np.minimum(starts + k, last)], 0)
        tail = (tail << 8) | np.where(size > k, codes[np.maximum(ends - k, 0)], 0)
        affixes[:, k], affixes[:, 3 + k] = _hashed(2 + k, head), _hashed(5 + k, tail)
    return grams, first, affixes


class Lexicon:
    """Hashes of words and, for each, the labels whose frequent words have it."""

    def __init__(self, words: list[np.ndarray]):
        """``words``: each label's."""
        held = np.concatenate([np.zeros(0, dtype=np.uint64), *words])
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        order = np.lexsort((owner, held))
        self.keys, counts = np.unique(held, return_counts=True)
        self.starts, self.owners = np.concatenate([[0], np.cumsum(counts)]), owner[order]

    def pairs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among ``words``, label), by place, for each lexicon that a word stands in."""
        if not len(self.keys):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        found = np.flatnonzero(self.keys[at] == words)
        first = self.starts[at[found]]
        count = self.starts[at[found] + 1] - first
        return np.repeat(found, count), self.owners[np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())]


class Model:
    def __init__(self, labels: list[str], lexicon: Lexicon):
        self.labels, self.lexicon = labels, lexicon
        n = len(labels)
        self.weights = np.zeros((1 << BITS, n), dtype=np.float32)
        self.entries = np.zeros((n, n), dtype=np.float32)
        self.transitions = np.zeros((n, n))

    def emissions(self, grams, first, affixes, lexical) -> np.ndarray:
        if not len(first):
            return np.zeros((0, len(self.labels)))
        score = np.add.reduceat(self.weights[grams], first, axis=0)
        for k in range(affixes.shape[1]):
            score += self.weights[affixes[:, k]]
        word, owner = lexical
        if len(word):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            score[word[starts]] += np.add.reduceat(self.entries[owner], starts, axis=0)
        return score.astype(np.float64)

    def posteriors(self, emissions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Marginal probabilities of each word's labels; ``bounds``: where each text's words begin, and the end."""
        n = len(self.labels)
        if not len(emissions):
            return emissions
        step = np.exp(self.transitions - self.transitions.max())
        sizes = np.diff(bounds)
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        total = int(first[-1])
        text = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(emissions)) - np.repeat(bounds[:-1], sizes)
        at = (first[text] + place // BLOCK, place % BLOCK)
        score = np.ones((total, BLOCK, n))
        score[at] = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + 1e-12
        real = np.zeros((total, BLOCK), dtype=bool)
        real[at] = True
        product = np.broadcast_to(np.eye(n), (total, n, n)).copy()
        for t in range(BLOCK):
            nxt = (product @ step) * score[:, t, None, :]
            nxt /= nxt.max(axis=(1, 2), keepdims=True)
            product = np.where(real[:, t, None, None], nxt, product)
        forward, backward = np.full((total, n), 1.0 / n), np.ones((total, n))
        for j in range(int(blocks.max())):
            here = first[:-1][blocks > j + 1] + j
            nxt = np.einsum("bi,bij->bj", forward[here], product[here])
            forward[here + 1] = nxt / nxt.sum(axis=1, keepdims=True)
        for j in range(int(blocks.max()) - 1, 0, -1):
            here = first[:-1][blocks > j] + j
            nxt = np.einsum("bij,bj->bi", product[here], backward[here])
            backward[here - 1] = nxt / nxt.max(axis=1, keepdims=True)
        alphas = np.empty((total, BLOCK, n))
        a = forward
        for t in range(BLOCK):
            a = (a @ step) * score[:, t]
            a /= a.sum(axis=1, keepdims=True)
            alphas[:, t] = a
        b = backward
        for t in range(BLOCK - 1, -1, -1):
            alphas[:, t] *= b
            nxt = (score[:, t] * b) @ step.T
            nxt /= nxt.max(axis=1, keepdims=True)
            b = np.where(real[:, t, None], nxt, b)
        out = alphas[at]
        return out / out.sum(axis=1, keepdims=True)


class Words:
    """The words of labelled texts in order of the labels: their bytes and places, and where each label's begin."""

    def __init__(self, texts: list[str], langs: list[str], labels: list[str]):
        order = sorted(range(len(texts)), key=lambda i: langs[i])
        batch = pa.RecordBatch.from_arrays([pa.array([texts[i] for i in order], pa.large_string())], names=["text"])
        owner, done, base = [labels.index(langs[i]) for i in order], 0, 0
        counts = np.zeros(len(labels), dtype=np.int64)
        parts, starts, ends, hashes = [], [], [], []
        for part in text_slices(batch):
            data, offsets = text_bytes(part.column("text"))
            words, bounds = word_hashes(data, offsets)
            first, last = word_places(data, offsets)
            np.add.at(counts, owner[done:done + part.num_rows], np.diff(bounds))
            parts.append(data.tobytes())
            starts.append(first + base)
            ends.append(last + base + 1)
            hashes.append(words)
            done, base = done + part.num_rows, base + len(data)
        self.data = b"".join(parts)
        self.starts, self.ends = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (starts, ends))
        self.bounds = np.concatenate([[0], np.cumsum(counts)])
        hashes = np.concatenate([np.zeros(0, dtype=np.uint64), *hashes])
        self.lexicon = Lexicon([_frequent(hashes[a:b]) for a, b in zip(self.bounds[:-1], self.bounds[1:])])

    def drawn(self, rng: np.random.Generator, chains: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, label) of training chains: stretches of a label's words, at times followed by another label's."""
        stretch, filled, places, labels = CHAIN // STRETCHES, np.flatnonzero(np.diff(self.bounds)), [], []
        for _ in range(chains):
            own = rng.choice(filled)
            for _ in range(STRETCHES):
                if rng.random() < 0.3:
                    own = rng.choice(filled)
                a, b = self.bounds[own], self.bounds[own + 1]
                at = a + int(rng.integers(max(1, b - a - stretch)))
                places.append(np.minimum(np.arange(at, at + stretch), b - 1))
                labels.append(np.full(stretch, own))
        return np.concatenate(places), np.concatenate(labels)

    def features(self, places: np.ndarray):
        """Features of some words, as :meth:`Model.emissions` takes them."""
        line = b" ".join([self.data[a:b] for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist())])
        data, offsets = np.frombuffer(line, dtype=np.uint8), np.array([0, len(line)])
        return *features(data, offsets), self.lexicon.pairs(word_hashes(data, offsets)[0])


def _frequent(words: np.ndarray) -> np.ndarray:
    """A label's ``LEXICON`` most frequent words of those that occur twice."""
    distinct, counts = np.unique(words, return_counts=True)
    often = np.argsort(-counts, kind="stable")[:LEXICON]
    return distinct[often[counts[often] > 1]]


def fit(texts: list[str], langs: list[str], rate: float = 0.3, batch: int = 64, seed: int = 7) -> Model:
    """CRF of the given labelled texts: log-likelihood by adaptive gradient steps. Features are made for the words of
    one batch of chains at a time."""
    labels = sorted(set(langs))
    words = Words(texts, langs, labels)
    model = Model(labels, words.lexicon)
    if not len(words.starts) or len(labels) < 2:
        return model
    rng = np.random.default_rng(seed)
    squares = [np.full_like(model.weights, 1e-3), np.full_like(model.entries, 1e-3), np.full_like(model.transitions, 1e-3)]
    for _ in range(CHAINS // batch):
        places, gold = words.drawn(rng, batch)
        grams, first, affixes, lexical = words.features(places)
        emissions = model.emissions(grams, first, affixes, lexical)
        chain = np.arange(0, len(places) + 1, CHAIN)
        right = np.zeros((len(places), len(labels)))
        right[np.arange(len(places)), gold] = 1
        error = right - model.posteriors(emissions, chain)
        gradient = np.zeros_like(model.weights)
        np.add.at(gradient, grams, np.repeat(error, np.diff(np.concatenate([first, [len(grams)]])), axis=0))
        for k in range(affixes.shape[1]):
            np.add.at(gradient, affixes[:, k], error)
        entries = np.zeros_like(model.entries)
        np.add.at(entries, lexical[1], error[lexical[0]])
        labelled = gold.reshape(-1, CHAIN)
        moves = np.zeros_like(model.transitions)
        np.add.at(moves, (labelled[:, :-1].ravel(), labelled[:, 1:].ravel()), 1.0)
        moves -= _expected_moves(model, emissions, len(labels))
        for value, slope, square in zip((model.weights, model.entries, model.transitions), (gradient, entries, moves), squares):
            slope = slope / batch - 1e-4 * value
            square += slope * slope
            value += (rate * slope / np.sqrt(square)).astype(value.dtype)
    return model


def _expected_moves(model: Model, emissions: np.ndarray, n: int) -> np.ndarray:
    """Expected counts of transitions in chains of ``CHAIN`` words."""
    step = np.exp(model.transitions - model.transitions.max())
    score = np.exp(emissions - emissions.max(axis=1, keepdims=True)).reshape(-1, CHAIN, n) + 1e-12
    alpha = np.empty_like(score)
    a = np.full((len(score), n), 1.0 / n)
    for t in range(CHAIN):
        a = (a @ step) * score[:, t]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    total, b = np.zeros((n, n)), np.ones((len(score), n))
    for t in range(CHAIN - 1, 0, -1):
        pair = alpha[:, t - 1, :, None] * step * (score[:, t] * b)[:, None, :]
        total += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = (score[:, t] * b) @ step.T
        b /= b.max(axis=1, keepdims=True)
    return total


def training_sample(docs: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """(text, lang): at most ``per_language`` labelled texts a language, one for each value of a hash of the row; of a
    longer text a stretch of ``SAMPLE_CHARS``, from where its hash says. Rows with null text or language are left out."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("slot", F.pmod("h", F.lit(per_language)))
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    rows = rows.withColumn("text", F.substring("text", (F.pmod("h", spare) + 1).cast("int"), F.lit(SAMPLE_CHARS)))
    chosen = rows.groupBy("lang", "slot").agg(F.min("h").alias("h"))
    found = rows.join(broadcast_if_small(chosen), ["lang", "slot", "h"], "left_semi")
    return found.dropDuplicates(["lang", "h"]).select("text", "lang")


def label_documents(docs: DataFrame, training: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_pred, score and runs for each row of ``docs`` (``keep`` and text); learned from
    ``training`` (text, lang).

    ``runs`` are the stretches of words with one most probable label, in order; ``lang_pred`` has the largest mean
    probability over the words (ties: the smaller name), ``score`` is that mean. A null text, one without a letter, or
    any text if nothing was learned, gets ``und``, score 0 and no runs. Repeated rows come back as often as they came
    in; an empty table gives an empty result."""
    sample = sorted(map(tuple, training_sample(training).collect()))
    model = docs.sparkSession.sparkContext.broadcast(fit([t for t, _ in sample], [x for _, x in sample]))
    # A text that is kept travels once.
    text = "text" if "text" in keep and docs.schema["text"].dataType.simpleString() == "string" else _TEXT
    rows = docs.select(*keep, *([F.col("text").cast("string").alias(_TEXT)] if text == _TEXT else []))
    schema = "".join(f"`{name}` {docs.schema[name].dataType.simpleString()}, " for name in keep)

    def run(batches):
        own = model.value
        names = np.array([*own.labels, "und"], dtype=object)
        for batch in batches:
            for part in text_slices(batch, text, SMALL_SLICE_BYTES):
                texts = part.column(text)
                data, offsets = text_bytes(texts)
                words, bounds = word_hashes(data, offsets)
                chances = own.posteriors(own.emissions(*features(data, offsets), own.lexicon.pairs(words)), bounds) \
                    if own.labels else np.zeros((len(words), 0))
                known = np.asarray(pc.fill_null(pc.match_substring_regex(texts, _LETTER), False)) & (np.diff(bounds) > 0)
                known &= len(own.labels) > 0
                best, score = np.full(len(texts), len(own.labels)), np.zeros(len(texts))
                if known.any():
                    sums = np.zeros((len(texts) + 1, len(own.labels)))
                    filled = np.flatnonzero(np.diff(bounds) > 0)
                    sums[filled] = np.add.reduceat(chances, bounds[:-1][filled], axis=0)
                    mean = sums[:-1] / np.maximum(np.diff(bounds), 1)[:, None]
                    best[known] = mean[known].argmax(axis=1)
                    score[known] = np.clip(mean[known].max(axis=1), 0.0, 1.0)
                label = chances.argmax(axis=1) if len(own.labels) and len(words) else np.zeros(len(words), dtype=int)
                cut = np.zeros(len(words) + 1, dtype=bool)
                cut[bounds] = True
                cut[1:-1] |= label[1:] != label[:-1]
                cut[-1:] = True
                starts = np.flatnonzero(cut[:-1])
                shown = np.repeat(known, np.diff(bounds))[starts] if len(words) else np.zeros(0, dtype=bool)
                lengths = np.diff(np.concatenate([starts, [len(words)]]))[shown] if len(starts) else np.zeros(0, dtype=int)
                starts = starts[shown]
                lists = np.searchsorted(starts, bounds).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(lists), pa.StructArray.from_arrays(
                    [pa.array(names[label[starts]].tolist(), pa.string()), pa.array(lengths, pa.int64())], ["lang", "words"]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), pa.array(names[best].tolist(), pa.string()),
                     pa.array(score), runs], names=[*keep, "lang_pred", "score", "runs"])

    return rows.mapInArrow(run, schema + "lang_pred string, score double, runs array<struct<lang: string, words: bigint>>")


def remainder(doc_id="doc_id"):
    """crc32 of the id as text, modulo 5; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def op6_crf_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = label_documents(docs, docs.where(remainder() != 0))
    return labelled.select("doc_id", (remainder() == 0).alias("held_out"), "lang_pred", "score")
