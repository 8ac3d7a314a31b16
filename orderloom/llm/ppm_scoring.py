"""Code length of texts by prediction by partial matching.

A trie of byte contexts up to ``ORDER`` bytes holds, for every context, how often each symbol (a byte or the end of the
text) followed it in the training texts. A symbol's probability is taken at the longest known context that has it;
each longer one is left by an escape, estimated by half its number of distinct symbols (method D), and its symbols are
excluded further down. Counts are made over all training texts and summed in Spark by shuffles. Where no order has more
than ``NODES`` entries the workers get the whole trie in flat form. Beyond that they get the values of the ``NODES`` most
frequent entries of the highest order, and all other symbols of the texts are joined with their values, which are made
in Spark from all counts, order by order.

Beside it stands a unigram model of words. Its counts are not broadcast: a text's words are joined with their counts by
hash; only the ``FREQUENT`` most frequent ones, which hold every hot word, are looked up in place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import mixed, settle, table, text_bytes, text_slices, to_int64, word_hashes
from orderloom.llm.crf_language import remainder

ORDER = 5
NODES = 1 << 21
FREQUENT = 1 << 18
END = 256
_SYMBOLS = 257
_WORD, _GRAM = 0, 1
#: Stands for the end of a text among words.
END_WORD = 0x1F3D5B79A2C4E687
_HELD = 2_000_000
_U = np.uint64


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte of each text, then its end: the ``ORDER`` bytes before (zeros before the beginning) and the symbol."""
    sizes = np.diff(offsets)
    n = len(data) + len(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    symbols = np.full(n, END, dtype=np.uint64)
    place = np.arange(len(data)) + text
    symbols[place] = data
    first = offsets[:-1] + np.arange(len(sizes))
    begin = np.repeat(first, sizes + 1)
    keys = np.zeros(n, dtype=np.uint64)
    for k in range(ORDER, 0, -1):
        before = np.zeros(n, dtype=np.uint64)
        before[k:] = symbols[:-k]
        before[np.arange(n) - k < begin] = 0
        keys = (keys << _U(8)) | before
    return (keys << _U(9)) | symbols


class Lookup:
    """Open-addressed hash table of 64-bit keys in arrays; finds many keys at once."""

    def __init__(self, keys: np.ndarray):
        self.shift = 64 - max(4, int(2 * len(keys)).bit_length() + 1)
        size = 1 << (64 - self.shift)
        self.index = np.full(size, -1, dtype=np.int32)
        self.keys = keys
        rows, slots = np.arange(len(keys), dtype=np.int32), self._slots(keys)
        while len(rows):
            free = self.index[slots] < 0
            self.index[slots[free]] = rows[free]  # of several for one slot the last stays
            lost = self.index[slots] != rows
            rows, slots = rows[lost], (slots[lost] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(self.shift)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int32)
        slots = self._slots(keys)
        found = self.index[slots]
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & (len(self.index) - 1)
            found[wrong] = self.index[slots[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self.keys[found[wrong]] != keys[wrong])]
        return found


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    """Keys with their contexts cut to the last ``order`` bytes."""
    return keys & _U((1 << (8 * order + 9)) - 1)


class Trie:
    """Flat trie: for each order the entries (context and symbol) and the contexts with what escaping from them costs.

    ``counts[k]``: (keys, counts) of order k."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        self.entries, self.contexts, self.direct, self.log_counts = [], [], [], []
        self.escape, self.lower, self.lower_escape = [], [], []
        tables = []
        for keys, n in counts:
            order = np.argsort(keys)
            tables.append((keys[order].astype(np.uint64), n[order].astype(np.float64)))
        for k, (keys, n) in enumerate(tables):
            context = keys >> _U(9)
            names, first = np.unique(context, return_index=True)
            sizes = np.diff(np.concatenate([first, [len(keys)]]))
            total = np.add.reduceat(n, first) if len(keys) else np.zeros(0)
            owner = np.repeat(np.arange(len(names)), sizes)
            whole = 2 * total
            self.entries.append(Lookup(keys))
            self.contexts.append(Lookup(names))
            self.direct.append(np.log10((2 * n - 1) / whole[owner]))
            self.log_counts.append(np.log10(2 * n - 1))
            self.escape.append(np.log10(sizes / whole))
            if not k:
                self.lower.append(np.zeros(len(names)))
                self.lower_escape.append(-np.log10(np.maximum(_SYMBOLS - sizes, 1)))
                below = names, total, sizes
                continue
            # What the next shorter context has left once this one's symbols are excluded.
            below_names, below_total, below_sizes = below
            at = np.searchsorted(below_names, names & _U((1 << (8 * (k - 1))) - 1))
            under = _suffix(keys, k - 1)
            row = self.entries[k - 1].find(under)
            shared = np.where(row >= 0, tables[k - 1][1][row], 0.0)
            at = np.minimum(at, max(len(below_names) - 1, 0))
            rest = below_total[at] - np.add.reduceat(shared, first)
            kinds = below_sizes[at] - np.add.reduceat((row >= 0).astype(float), first)
            self.lower.append(np.where(rest > 0, np.log10(np.maximum(2 * rest, 1)), 0.0))
            self.lower_escape.append(np.where(kinds > 0, np.log10(np.maximum(kinds, 1) / np.maximum(2 * rest, 1)), 0.0))
            below = names, total, sizes

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol in its context."""
        out = np.zeros(len(keys))
        top = len(self.entries) - 1
        row = self.entries[top].find(keys)
        hit = row >= 0
        out[hit] = self.direct[top][row[hit]]
        rest = np.flatnonzero(~hit)
        if not len(rest):
            return out
        left = keys[rest]
        above = self.contexts[top].find(left >> _U(9))  # the context that was escaped from, -1: none was known so far
        value = np.where(above >= 0, self.escape[top][above], 0.0) if len(self.escape[top]) else np.zeros(len(rest))
        for k in range(top - 1, -1, -1):
            key = _suffix(left, k)
            row = self.entries[k].find(key)
            context = self.contexts[k].find(key >> _U(9))
            hit = row >= 0
            plain = above < 0
            if len(self.direct[k]):
                den = self.lower[k + 1][above] if len(self.lower[k + 1]) else 0.0
                gain = np.where(plain, self.direct[k][row], self.log_counts[k][row] - den)
                out[rest[hit]] = (value + gain)[hit]
            miss = ~hit
            rest, left, value, context, above, plain = (x[miss] for x in (rest, left, value, context, above, plain))
            if not len(rest):
                return out
            if len(self.escape[k]):
                after = self.lower_escape[k + 1][above] if len(self.lower_escape[k + 1]) else 0.0
                value = value + np.where(context < 0, 0.0, np.where(plain, self.escape[k][context], after))
            above = np.where(context >= 0, context, -1)
        none = -np.log10(_SYMBOLS)
        out[rest] = value + (np.where(above >= 0, self.lower_escape[0][above], none) if len(self.lower_escape[0]) else none)
        return out


class Frequent:
    """Values of the most frequent entries of the highest order."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.entries, self.values = Lookup(keys), values

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol in its context, NaN where it has to be joined."""
        row = self.entries.find(keys)
        return np.where(row >= 0, self.values[row], np.nan) if len(self.values) else np.full(len(keys), np.nan)


class Model:
    """What the workers get: the trie's counts (all of them) or values of its frequent entries, and counts of the frequent
    words; the lookups are made there, once a worker."""

    def __init__(self, tables, frequent, words: np.ndarray, counts: np.ndarray):
        self.tables, self.frequent, self.words, self.counts, self.made = tables, frequent, words, counts, None

    def ready(self) -> tuple[Trie | Frequent, Lookup, np.ndarray]:
        if self.made is None:
            trie = Frequent(*self.frequent) if self.tables is None else Trie(self.tables)
            self.made = trie, Lookup(self.words), np.log10(self.counts + 0.5)
        return self.made


def count_training(docs: DataFrame) -> DataFrame:
    """(kind, key, n): words (with ends of texts) and byte contexts with symbols of all given texts, summed."""

    def run(batches):
        held = {_WORD: [], _GRAM: []}
        size = 0

        def merged(kind):
            keys, n = (np.concatenate(x) for x in zip(*held[kind]))
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[first], np.add.reduceat(n, first)

        def out():
            for kind in held:
                if held[kind]:
                    keys, n = merged(kind)
                    for a in range(0, len(keys), 100_000):
                        part = slice(a, a + 100_000)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(keys[part]), kind, dtype=np.int32)), pa.array(to_int64(keys[part])),
                             pa.array(n[part])], names=["kind", "key", "n"])
                    held[kind].clear()

        for batch in batches:
            for part in text_slices(batch):
                data, offsets = text_bytes(part.column("text"))
                words, _ = word_hashes(data, offsets)
                for kind, keys in ((_WORD, words), (_GRAM, grams(data, offsets))):
                    keys, n = np.unique(keys, return_counts=True)
                    held[kind].append((keys, n.astype(np.int64)))
                    size += len(keys)
                held[_WORD].append((np.array([END_WORD], dtype=np.uint64), np.array([part.num_rows], dtype=np.int64)))
                if size > _HELD:
                    for kind in held:
                        held[kind] = [merged(kind)]
                    size = sum(len(held[k][0][0]) for k in held)
                    if size > _HELD // 2:
                        yield from out()
                        size = 0
        yield from out()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def entries_of(counts: DataFrame, order: int) -> DataFrame:
    """(key, n): the trie's entries (context and symbol) of an order; those below the highest by summing over the bytes
    that they lack."""
    key = F.col("key").bitwiseAND(F.lit((1 << (8 * order + 9)) - 1)).alias("key")
    return counts.where(F.col("kind") == _GRAM).groupBy(key).agg(F.sum("n").alias("n"))


def read_contexts(counts: DataFrame, order: int = ORDER) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of all entries, by order."""
    tables = []
    for k in range(order + 1):
        frame = entries_of(counts, k).toArrow()
        tables.append((frame.column("key").to_numpy().astype(np.uint64), frame.column("n").to_numpy()))
    return tables


class SparkTrie:
    """The trie as tables: for each order the entries (key, n) and the contexts (context, total, kinds, rest,
    rest_kinds). ``rest`` and ``rest_kinds``: what the next shorter context has left without this one's symbols."""

    def __init__(self, counts: DataFrame):
        self.entries = [settle(entries_of(counts, k), f"order-{k}") for k in range(ORDER + 1)]
        self.contexts = []
        for k, entries in enumerate(self.entries):
            rows = entries.withColumn("context", F.shiftright("key", 9))
            sums = [F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")]
            if not k:
                nothing = F.lit(0).cast("bigint")
                own = rows.groupBy("context").agg(*sums).withColumns({"rest": nothing, "rest_kinds": nothing})
            else:  # every entry has its shorter one, which has at most 256 longer ones
                under = self.entries[k - 1].select(F.col("key").alias("under"), F.col("n").alias("n_under"))
                own = rows.withColumn("under", F.col("key").bitwiseAND(F.lit((1 << (8 * k + 1)) - 1))).join(
                    under, "under").groupBy("context").agg(*sums, F.sum("n_under").alias("shared"))
                below = self.contexts[-1].select(F.col("context").alias("below"), F.col("total").alias("total_below"),
                                                 F.col("kinds").alias("kinds_below"))
                own = own.withColumn("below", F.col("context").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))).join(
                    below, "below").select("context", "total", "kinds", (F.col("total_below") - F.col("shared")).alias("rest"),
                                           (F.col("kinds_below") - F.col("kinds")).alias("rest_kinds"))
            self.contexts.append(settle(own, f"contexts-{k}"))

    def frequent(self, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the most frequent entries of the highest order, and their values."""
        rows = self.entries[-1].orderBy(F.desc("n"), "key").limit(limit).withColumn("context", F.shiftright("key", 9))
        value = F.log10((2 * F.col("n") - 1) / (2 * F.col("total")))
        frame = rows.join(self.contexts[-1], "context").select("key", value.alias("value")).toArrow()
        return frame.column("key").to_numpy().astype(np.uint64), frame.column("value").to_numpy()

    def log10(self, keys: DataFrame) -> DataFrame:
        """(key, value) for each of the distinct ``keys``: log10 probability of the symbol in its context.

        From the lowest order up, over the distinct contexts and symbols of that order: ``value`` if no longer context
        is known, ``after`` once this context was escaped from. No row of a join meets more than 257 others."""
        none = F.lit(float(-np.log10(_SYMBOLS)))
        lower = None
        for k in range(ORDER + 1):
            rows = keys.select(F.col("key").bitwiseAND(F.lit((1 << (8 * k + 9)) - 1)).alias("key")).distinct()
            rows = rows.withColumn("context", F.shiftright("key", 9)).join(self.entries[k], "key", "left").join(
                self.contexts[k], "context", "left")
            if k:
                rows = rows.withColumn("under", F.col("key").bitwiseAND(F.lit((1 << (8 * k + 1)) - 1))).join(lower, "under", "left")
                rest, kinds = F.greatest(2 * F.col("rest"), F.lit(1)), F.greatest("rest_kinds", F.lit(1))
                gain = F.log10(2 * F.col("n_under") - 1) - F.when(F.col("rest") > 0, F.log10(rest)).otherwise(F.lit(0.0))
                leave = F.when(F.col("rest_kinds") > 0, F.log10(kinds / rest)).otherwise(F.lit(0.0))
                after = F.when(F.col("n_under").isNotNull(), gain).otherwise(leave + F.col("after_under"))
                unknown = F.col("value_under")
            else:
                after, unknown = -F.log10(F.greatest(_SYMBOLS - F.col("kinds"), F.lit(1))), none
            value = F.when(F.col("n").isNotNull(), F.log10((2 * F.col("n") - 1) / (2 * F.col("total")))).when(
                F.col("total").isNotNull(), F.log10(F.col("kinds") / (2 * F.col("total"))) + after).otherwise(unknown)
            rows = settle(rows.select("key", "n", value.alias("value"), after.alias("after")), f"values-{k}")
            lower = rows.select(F.col("key").alias("under"), F.col("n").alias("n_under"),
                                F.col("value").alias("value_under"), F.col("after").alias("after_under"))
        return rows.select("key", "value")


def score_documents(docs: DataFrame, training: Column, nodes: int = NODES) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs`` (doc_id, text, and what
    ``training`` needs); learned from the rows that ``training`` marks.

    ``score`` is the log10 probability of the text's bytes and its end under the trie, ``base_score`` that of its words
    and end under the unigram counts. Null texts count as empty (their end is still a token); without training rows
    every symbol is equally likely. ``nodes`` only decides what is looked up in place. Repeated rows come back as often as they came in, a null doc_id stays null; an empty
    table gives an empty result."""
    spark = docs.sparkSession
    counts = settle(count_training(docs.where(training)), "counts")
    words = counts.where(F.col("kind") == _WORD)
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    often = words.orderBy(F.desc("n"), "key").limit(FREQUENT).select("key", "n").toArrow()
    # No lower order has more entries than the highest.
    whole = counts.where(F.col("kind") == _GRAM).count() <= nodes
    stored = None if whole else SparkTrie(counts)
    model = spark.sparkContext.broadcast(Model(
        read_contexts(counts) if whole else None, None if whole else stored.frequent(nodes), often.column("key").to_numpy().view(np.uint64), often.column("n").to_numpy()))

    def run(batches):
        trie, common, logs = model.value.ready()
        number = TaskContext.get().partitionId() << 33
        end = common.find(np.array([END_WORD], dtype=np.uint64))[0]
        for batch in batches:
            for part in text_slices(batch):
                data, offsets = text_bytes(part.column("text"))
                keys = grams(data, offsets)
                logs_of = trie.log10(keys)
                first = offsets[:-1] + np.arange(part.num_rows)
                open_ = np.flatnonzero(np.isnan(logs_of))
                logs_of[open_] = 0.0
                score = np.add.reduceat(logs_of, first)
                open_lists = np.searchsorted(open_, [*first, len(keys)]).astype(np.int32)
                hashes, bounds = word_hashes(data, offsets)
                row = common.find(hashes)
                hit = np.concatenate([[0], np.cumsum(row >= 0)])
                value = np.concatenate([[0.0], np.cumsum(np.where(row >= 0, logs[row], 0.0) if len(logs) else np.zeros(len(row)))])
                rare = np.flatnonzero(row < 0)
                lists = np.searchsorted(rare, bounds).astype(np.int32)
                tokens = np.diff(bounds) + 1
                ends = logs[end] if end >= 0 else 0.0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + part.num_rows)), part.column("doc_id"),
                     pa.array(tokens.astype(np.int64)), pa.array((np.diff(hit[bounds]) + int(end >= 0)).astype(np.int64)),
                     pa.array(np.diff(value[bounds]) + ends), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(lists), pa.array(to_int64(hashes[rare]))),
                     pa.ListArray.from_arrays(pa.array(open_lists), pa.array(to_int64(keys[open_])))],
                    names=["row", "doc_id", "n_tokens", "n_known", "known", "score", "rare", "open"])
                number += part.num_rows

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = settle(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, n_known long, known double, score double, "
        "rare array<bigint>, open array<bigint>"), "scored")
    rare = scored.select("row", F.explode("rare").alias("key"))
    found = rare.join(words.select("key", "n"), "key", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_value"),
        F.count_if(F.col("n") > 0).alias("rare_known"))
    if not whole:
        symbols = scored.select("row", F.explode("open").alias("key"))
        values = stored.log10(settle(symbols.select("key").distinct(), "symbols"))
        joined = symbols.join(values, "key").groupBy("row").agg(F.sum("value").alias("open_value"))
        scored = scored.join(joined, "row", "left").withColumn(
            "score", F.col("score") + F.coalesce("open_value", F.lit(0.0))).drop("open_value")
    scale = float(np.log10(size["n"] + 0.5 * (size["v"] + 1)))
    # The end is rare too where no training text exists; its log10 of 0.5 belongs to the sum then.
    ends = 0.0 if size["n"] else float(np.log10(0.5))
    return scored.drop("rare", "open").join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(size["n"]).cast("bigint").alias("train_tokens"),
        (F.col("known") + F.coalesce("rare_value", F.lit(0.0)) + ends - F.col("n_tokens") * scale).alias("base_score"), "score")


def op7_ppm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, remainder() != 1).select(
        "doc_id", (remainder() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
