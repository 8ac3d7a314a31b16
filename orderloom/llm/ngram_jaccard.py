"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct word shingles. Two documents link when ``100 * intersection >= threshold * union``.
Size windows ``[low, high]`` are laid so that the smaller set of any linked pair starts a window that also holds the
larger one. Within a window two linked sets differ in at most ``k`` shingles, so of ``n1 > k`` parts of the shingle
domain at least one holds the same shingles in both: the hash of one part's content is a signature, and each set
enumerates one per part. A set with more than ``k`` parts that are not empty leaves the empty ones out, which loses
nothing, as one of its non-empty parts must still agree. Of its ``p`` non-empty parts all but ``k`` agree with those of
any set linked to it. So a set that shares fewer signatures links with nothing in that window, and of those shared, in
one order for all sets, each may leave out the last ``p - k - 1``: two linked sets still have one in common. The order
goes from signatures of few sets to those of many, so what goes are those of lines that many texts have.

Sets sharing a signature are candidates. They are linked without listing all pairs of a group: rounds of star pairs
(one pivot per signature) are verified, components are formed, and only signatures that still hold several components
go on; what is left at last is compared across components. Verification first compares sketches (one byte per part,
sums of shingle hashes; the number of differing bytes never exceeds the true difference, so nothing is lost) and then
whole sets. Equal sets are one class from the start, so copies are never compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.llm.common import (SMALL_SLICE_BYTES, components, mixed, settle, text_bytes, text_slices, to_int64,
                                  word_hashes)
from orderloom.operators.sized import broadcast_if_small

_U = np.uint64
#: Signatures that a bucket should hold, about 16 bytes each: what one reducing call has in memory.
BUCKET_SIGNATURES = 1_000_000
#: Rounds of star pairs, each with so many pivots among the signatures that a group of documents shares: where a
#: group's members are near the threshold, several pivots join what one leaves apart.
STAR_PIVOTS = (1, 8, 32)
_WIRE = 1_000_000
#: Low bits of a signature that hold its window; there are about 100 windows up to a billion shingles.
_WINDOW = 255


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    data, offsets = text_bytes(texts)
    words, bounds = word_hashes(data, offsets)
    grams = np.zeros(0, dtype=np.uint64)
    if len(words) >= width:
        size = len(words) - width + 1
        grams = np.zeros(size, dtype=np.uint64)
        for k in range(width):
            grams = (grams ^ words[k:k + size]) * _U(0xD6E8FEB86659FD93)
            grams ^= grams >> _U(32)
        grams = mixed(grams)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= width:
            own = np.sort(grams[a:b - width + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            h = _U(b - a)
            for w in words[a:b]:
                h = mixed((np.array([h], dtype=np.uint64) ^ w) * _U(0xC2B2AE3D27D4EB4F))[0]
            yield np.array([h], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def set_key(own: np.ndarray) -> int:
    """64-bit identity of a set."""
    total = np.add.reduce(mixed(own + _U(0x2545F4914F6CDD1D))) + _U(len(own))
    return int(mixed(np.array([total], dtype=np.uint64)).view(np.int64)[0])


class Windows:
    """Size windows: ``of(size)`` gives (window, parts, k) of each window that a set of that size takes part in."""

    def __init__(self, threshold: int):
        self.threshold, self.lows = threshold, [1]

    def difference(self, total: int) -> int:
        """Largest difference of two linked sets with ``total`` shingles together."""
        return total * (100 - self.threshold) // (100 + self.threshold)

    def of(self, size: int) -> list[tuple[int, int, int]]:
        while self.lows[-1] <= size:
            low = self.lows[-1]
            self.lows.append(max(low + 1, low * 100 // self.threshold))
        j = int(np.searchsorted(self.lows, size, side="right")) - 1
        found = []
        while j >= 0:
            last = self.lows[j + 1] - 1
            high = last * 100 // self.threshold
            if size > high:
                break
            k = self.difference(last + high)
            if k:
                found.append((j, max(k + 2, -(-last * 31 // 100) + 2), k))
            j -= 1
        return found


def _parts(own: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Each shingle's part, and where in the sorted set the parts that are not empty start."""
    part = ((own >> _U(32)) * _U(parts)) >> _U(32)
    return part, np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])


def signatures(own: np.ndarray, windows: Windows) -> np.ndarray:
    found = [np.zeros(0, dtype=np.uint64)]
    for window, parts, k in windows.of(len(own)):
        part, starts = _parts(own, parts)
        ids, sums = part[starts], np.add.reduceat(own, starts)
        if len(ids) <= k:
            ids, sums = np.arange(parts, dtype=np.uint64), np.bincount(ids.astype(int), minlength=parts).astype(np.uint64)
            sums[part[starts].astype(int)] = np.add.reduceat(own, starts)
        sig = mixed(sums ^ mixed((ids + _U(1)) * _U(0x9E3779B97F4A7C15) + _U(window + 1)))
        found.append(sig & ~_U(_WINDOW) | _U(window & _WINDOW))
    return np.concatenate(found)


def shared_at_least(own: np.ndarray, windows: Windows) -> list[tuple[int, int]]:
    """(window, signatures) for each window: as many as the set shares there with any set that it links with. One, if
    it lists empty parts too, which the other set may leave out."""
    return [(window & _WINDOW, max(len(_parts(own, parts)[1]) - k, 1)) for window, parts, k in windows.of(len(own))]


def sketch(own: np.ndarray) -> bytes:
    """One byte for each of 2^p parts of the domain, 2^p being about half to all of the size: byte sums of hashes."""
    bits = max(1, len(own).bit_length() - 1)
    part = (own >> _U(64 - bits)).astype(np.int64)
    return np.bincount(part, weights=(own & _U(255)).astype(float), minlength=1 << bits).astype(np.int64).astype(np.uint8).tobytes()


def sketches_differ(a: np.ndarray, b: np.ndarray) -> int:
    """Lower bound of the difference of two sets: parts whose sums differ, at the coarser of the two resolutions."""
    while len(a) > len(b):
        a = a.reshape(-1, 2).sum(axis=1, dtype=np.uint8)
    while len(b) > len(a):
        b = b.reshape(-1, 2).sum(axis=1, dtype=np.uint8)
    return int(np.count_nonzero(a != b))


def ngram_jaccard_components(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text; other columns are ignored).

    ``component_id`` is the smallest doc_id reachable by links, the row's own included. Null and empty texts have no
    shingles and link with nothing; so their component is their own doc_id. A text with fewer words than ``width`` is
    one shingle. Repeated rows come back as often as they came in; a null doc_id is kept, and is a component's id only
    if all its rows have none. An empty table gives an empty result."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def keys(batches):
        windows, least = Windows(threshold), pa.list_(pa.struct([("window", pa.int32()), ("least", pa.int32())]))
        for batch in batches:
            for part in text_slices(batch, most=SMALL_SLICE_BYTES):
                sets = list(shingle_sets(part.column("text"), width))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([[{"window": w, "least": m} for w, m in shared_at_least(s, windows)] for s in sets], least)],
                    names=["doc_id", "n_shingles", "key", "windows"])

    members = settle(docs.mapInArrow(keys, "doc_id long, n_shingles long, key long, windows array<struct<window: int, least: int>>"),
                     "members")
    classes = settle(members.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min("n_shingles").alias("n"), F.min("windows").alias("windows")), "classes")
    runs = _needed(_shared_signatures(docs, classes, width, threshold), classes)
    linked = _link(docs, classes, runs, width, threshold)
    if linked is None:
        own = classes.select("key", F.col("least").alias("found"))
    else:
        named = classes.join(linked, "key", "left").withColumn("component", F.coalesce("component", "key"))
        least = named.groupBy("component").agg(F.min("least").alias("found"))
        own = named.join(least, "component").select("key", "found")
    return members.join(own, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))


def _shared_signatures(docs: DataFrame, classes: DataFrame, width: int, threshold: int) -> DataFrame:
    """(sig, key, often): signatures that at least two classes have, and how many have it. Signatures travel packed,
    dealt by their own value."""
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = int(max(64, total // BUCKET_SIGNATURES + 1))

    def enumerate_(batches):
        windows, seen, held, size = Windows(threshold), set(), [], 0

        def flush():
            sig, key = (np.concatenate(x) for x in zip(*held))
            bucket = (((sig >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sig, key, bucket = sig[order], key[order], bucket[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(sig)]])
            ids, sigs, names, owners = [], [], [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                own, index = np.unique(key[a:b], return_inverse=True)
                ids.append(int(bucket[a]))
                sigs.append(sig[a:b].tobytes())
                names.append(own.tobytes())
                owners.append(index.astype(np.uint32).tobytes())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(sigs, pa.binary()),
                                               pa.array(names, pa.binary()), pa.array(owners, pa.binary())],
                                              names=["bucket", "sigs", "names", "owners"])

        for batch in batches:
            for part in text_slices(batch, most=SMALL_SLICE_BYTES):
                for own in shingle_sets(part.column("text"), width):
                    if len(own) and (key := set_key(own)) not in seen:
                        seen.add(key)
                        if len(sig := signatures(own, windows)):
                            held.append((sig, np.full(len(sig), key, dtype=np.int64)))
                            size += len(sig)
                if size >= _WIRE:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def shared(group: pa.Table) -> pa.Table:
        sig = np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint64) for x in group.column("sigs")])
        key = np.concatenate([np.frombuffer(n.as_py(), dtype=np.int64)[np.frombuffer(o.as_py(), dtype=np.uint32)]
                              for n, o in zip(group.column("names"), group.column("owners"))])
        order = np.argsort(sig)
        sig = sig[order]
        same = sig[1:] == sig[:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        sig, key = sig[shared], key[order[shared]]
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        fresh = np.ones(len(sig), dtype=bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])  # a class met by several tasks counts once
        sig, key = sig[fresh], key[fresh]
        often = np.unique(sig, return_counts=True)[1]
        often = np.repeat(often, often)
        shared = often > 1
        return pa.table({"sig": pa.array(to_int64(sig[shared])), "key": pa.array(key[shared]), "often": pa.array(often[shared])})

    packed = docs.select("text").mapInArrow(enumerate_, "bucket int, sigs binary, names binary, owners binary")
    return packed.groupBy("bucket").applyInArrow(shared, "sig long, key long, often long")


def _needed(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(sig, key) of the shared signatures by which linked classes find each other: none in windows where a class shares
    too few to link, and else all but the most frequent that it can do without."""
    least = classes.select("key", F.explode("windows").alias("of")).select("key", "of.window", "of.least")
    own = Window.partitionBy("key", "window")
    spent = F.count("sig").over(own) - F.col("least")
    ranked = shared.withColumn("window", F.col("sig").bitwiseAND(_WINDOW).cast("int")).join(least, ["key", "window"]).select(
        "sig", "key", F.row_number().over(own.orderBy("often", "sig")).alias("place"), spent.alias("spent"))
    kept = settle(ranked.where("place <= spent + 1").select("sig", "key"), "kept")
    several = kept.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return settle(kept.join(several.select("sig"), "sig", "left_semi"), "runs")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int, form) -> DataFrame:
    """(key, n, body) of the wanted classes, made anew from the text of each class's first document."""
    first = classes.join(wanted, "key", "left_semi").select(F.col("least").alias("first"))
    chosen = docs.join(broadcast_if_small(first), F.col("doc_id").eqNullSafe(F.col("first")), "left_semi").select("text")

    def make(batches):
        for batch in batches:
            for part in text_slices(batch, most=SMALL_SLICE_BYTES):
                sets = [s for s in shingle_sets(part.column("text"), width) if len(s)]
                if sets:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([set_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                         pa.array([form(s) for s in sets], pa.binary())], names=["key", "n", "body"])

    made = chosen.mapInArrow(make, "key long, n long, body binary").join(wanted, "key", "left_semi")
    return settle(made.dropDuplicates(["key"]), "sets")


def _tested(pairs: DataFrame, bodies: DataFrame, threshold: int, whole: bool) -> DataFrame:
    """Pairs (a, b) that pass: by sketches all that may link, by whole sets exactly those that do."""
    left = bodies.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("body").alias("ba"))
    right = bodies.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("body").alias("bb"))
    windows = Windows(threshold)

    def test(batches):
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("ba"), batch.column("bb"))):
                if whole:
                    x, y = (np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in (x, y))
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = 100 * common >= threshold * (len(x) + len(y) - common)
                else:
                    x, y = (np.frombuffer(z.as_buffer(), dtype=np.uint8) for z in (x, y))
                    keep[i] = sketches_differ(x, y) <= windows.difference(int(na[i] + nb[i]))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    near = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold)
    return pairs.join(left, "a").join(right, "b").where(near).mapInArrow(test, "a long, b long")


def _link(docs: DataFrame, classes: DataFrame, runs: DataFrame, width: int, threshold: int) -> DataFrame | None:
    """(key, component) of the classes that share signatures, by verified links: as many as connect all that linked
    pairs connect. Links that are found later only connect the components that there are, not the classes again."""
    if runs.isEmpty():
        return None
    keys = settle(runs.select("key").distinct(), "keys")
    outlines = _sets(docs, classes, keys, width, sketch)

    def verified(pairs: DataFrame) -> DataFrame:
        likely = settle(_tested(pairs, outlines, threshold, False), "likely")
        named = likely.select(F.col("a").alias("key")).union(likely.select(F.col("b").alias("key"))).distinct()
        whole = _sets(docs, classes, named, width, lambda s: s.tobytes())
        return settle(_tested(likely, whole, threshold, True), "links")

    named, active = keys.withColumn("component", F.col("key")), runs.withColumn("component", F.col("key"))
    for pivots in STAR_PIVOTS:
        rank = F.xxhash64("key", F.pmod("sig", F.lit(pivots)), F.lit(pivots))
        pivots = active.groupBy("sig").agg(F.min(F.struct(rank.alias("h"), "key", "component")).alias("p"))
        pairs = active.join(pivots, "sig").where("p.component <> component").select(
            F.least("p.key", "key").alias("a"), F.greatest("p.key", "key").alias("b")).distinct()
        found = verified(pairs)
        if found.isEmpty():
            break
        named = _merged(named, found)
        active = _unsettled(active, named)
        if active.isEmpty():
            return named
    rest = settle(_across(active, outlines, threshold).distinct(), "rest")
    found = verified(rest)
    return named if found.isEmpty() else _merged(named, found)


def _merged(named: DataFrame, links: DataFrame) -> DataFrame:
    """``named`` (key, component) with the components that ``links`` (a, b) connect made one."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(named.select(F.col("key").alias(end), F.col("component").alias(f"of_{end}")), end)
    joined = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).where("a <> b").distinct())
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return settle(named.join(joined, "component", "left").select("key", F.coalesce("least", "component").alias("component")),
                  "named")


def _unsettled(active: DataFrame, named: DataFrame) -> DataFrame:
    """(sig, key, component) of the signatures whose classes lie in several components."""
    current = active.select("sig", "key").join(named, "key")
    several = current.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return settle(current.join(several.select("sig"), "sig", "left_semi").select("sig", "key", "component"), "active")


def _across(active: DataFrame, outlines: DataFrame, threshold: int) -> DataFrame:
    """Pairs of one signature and different components whose sketches let them link.

    Rows come sorted by signature; one signature's sketches are compared a member at a time, so memory holds one group
    of sketches, and only pairs that pass leave."""
    windows = Windows(threshold)

    def compare(batches):
        held: list[tuple[int, int, int, int, bytes]] = []
        sent: set[tuple[int, int]] = set()  # of this task; other tasks' pairs are made distinct later

        def pairs():
            found: list[tuple[int, int]] = []
            by_size: dict[int, list[int]] = {}
            bodies = [np.frombuffer(x[4], dtype=np.uint8) for x in held]
            for i, body in enumerate(bodies):
                by_size.setdefault(len(body), []).append(i)
            stacks = {size: (np.array(rows), np.stack([bodies[i] for i in rows]),
                             np.array([held[i][2] for i in rows]), np.array([held[i][3] for i in rows]))
                      for size, rows in by_size.items()}
            for i, (_, key, component, n, _) in enumerate(held):
                body = bodies[i]
                for size, (rows, stack, comps, sizes) in stacks.items():
                    if size < len(body) or size > 2 * len(body):
                        continue
                    later = (rows > i) | (size != len(body))
                    later &= comps != component
                    later &= np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * threshold
                    index = np.flatnonzero(later)
                    if not len(index):
                        continue
                    other = stack[index]
                    if size != len(body):
                        other = other.reshape(len(index), -1, 2).sum(axis=2, dtype=np.uint8)
                    apart = np.count_nonzero(other != body, axis=1)
                    limit = (sizes[index] + n) * (100 - windows.threshold) // (100 + windows.threshold)
                    found += [(min(key, held[rows[x]][1]), max(key, held[rows[x]][1])) for x in index[apart <= limit]]
            held.clear()
            fresh = set(found) - sent
            if len(sent) < _WIRE:
                sent.update(fresh)
            return list(fresh)

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                               pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        sig = None
        for batch in batches:
            found = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("sig", "key", "component", "n", "body"))):
                if row[0] != sig and held:
                    found += pairs()
                sig = row[0]
                held.append(row)
            if found:
                yield out(found)
        if held and (found := pairs()):
            yield out(found)

    spread = active.join(outlines, "key").select("sig", "key", "component", "n", "body")
    return spread.repartition("sig").sortWithinPartitions("sig").mapInArrow(compare, "a long, b long")


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    from orderloom.llm.common import table
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))
