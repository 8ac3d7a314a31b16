"""Approximate nearest neighbours by NN-descent and greedy graph search.

The graph of nearest neighbours is refined by rounds of joins: every node meets its neighbours and the nodes that list
it (a sample of those, as the method has it), together with their vectors; all pairs of one such neighbourhood of which
at least one is new are compared, and what beats a node's worst neighbour is sent to it and merged. The first lists
come from blocks of nodes that lie closest to the same axes of random rotations. A query walks the graph greedily: the nearest
found, not yet visited nodes are expanded by a join with the graph and their neighbours scored, until the list does not
change. Vectors travel as bytes (eight bits a component) while the graph is built and searched; the nodes of the last
list are scored on the original vectors in double precision.

Inner products are turned into nearness between stored vectors by one more component, which gives all of them the same
length; queries have 0 there, so their order of candidates is that of the inner products. The added component travels
as a float beside the bytes, so one very long vector does not coarsen the others."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import mixed, settle, table

K = 40
#: Nodes that list a node which it meets, on average at most, and which a search may step to.
REVERSE = 28
#: First lists: random rotations with their axes, and nodes of a block that are compared.
ROTATIONS, AXES, BLOCK = 6, 24, 1024
ROUNDS, QUIET = 4, 0.02
#: Candidates that each member of a neighbourhood gets from it at most; a node merges those of all.
OFFERS = 12
#: Length of a query's list, nodes that a step expands, steps, and what is scored exactly.
BEAM, EXPAND, STEPS, EXACT = 200, 32, 5, 64
_FLUSH = 1_500_000
_U = np.uint64


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(id, vec) of the rows whose vector has finite components only, is not zero, and is as long as most."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.select(F.col("vec_id").cast("bigint").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad.eqNullSafe(True) & F.exists("vec", lambda x: x != 0))
    sizes = good.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1)
    return good.join(F.broadcast(sizes.select("d")), F.size("vec") == F.col("d"), "left_semi")  # one row


def _coded(vectors: DataFrame) -> DataFrame:
    """(id, code, scale): the vector in bytes; behind them two floats, the component that makes it as long as the longest
    and what that one lacks to the greatest length."""
    longest = vectors.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0

    def code(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = np.stack([x.values.to_numpy() for x in batch.column("vec")])
            square = (vec * vec).sum(axis=1)
            last = np.sqrt(np.maximum(longest - square, 0.0))
            added = np.stack([last, square / (np.sqrt(longest) + last)], axis=1).astype(np.float32)
            scale = np.abs(vec).max(axis=1) / 127
            codes = np.rint(vec / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([c.tobytes() + x.tobytes() for c, x in zip(codes, added)], pa.binary()), pa.array(scale)],
                names=["id", "code", "scale"])

    return vectors.mapInArrow(code, "id long, code binary, scale double")


def _decoded(codes: pa.Array, scales: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors, and the two floats behind each."""
    raw = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), -1)
    vec = raw[:, :-8].view(np.int8).astype(np.float32) * scales.to_numpy().astype(np.float32)[:, None]
    return vec, np.ascontiguousarray(raw[:, -8:]).view(np.float32)


def _nearness(vec: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Inner products of all pairs with the added component, less what is the same for the whole row: that can be far
    greater than the differences between vectors."""
    return vec @ vec.T - added[:, :1] * added[:, 1]


class Offers:
    """Candidates (node, neighbour, score) of one task, reduced to each node's best before they leave."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, node: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
        self.held.append((node, other, score))
        self.size += len(node)

    def flush(self, keep: int = K) -> pa.RecordBatch:
        node, other, score = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        node, other, score = best(node, other, score, keep)
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        lists = np.concatenate([starts, [len(node)]]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[starts]), pa.ListArray.from_arrays(pa.array(lists), pa.array(other)),
             pa.ListArray.from_arrays(pa.array(lists), pa.array(score.astype(np.float32)))], names=["id", "nbr", "sim"])


def best(node, other, score, keep: int):
    """Each node's ``keep`` best distinct neighbours, nearest first, ties to the smaller id."""
    order = np.lexsort((other, -score, node))
    node, other, score = node[order], other[order], score[order]
    pair = np.lexsort((other, node))  # a pair may have come several times, with one score
    fresh = np.ones(len(node), dtype=bool)
    fresh[pair[1:]] = (node[pair[1:]] != node[pair[:-1]]) | (other[pair[1:]] != other[pair[:-1]])
    node, other, score = node[fresh], other[fresh], score[fresh]
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, dtype=int)
    rank = np.arange(len(node)) - np.repeat(first, np.diff(np.concatenate([first, [len(node)]])))
    top = rank < keep
    return node[top], other[top], score[top]


def _first_lists(coded: DataFrame) -> DataFrame:
    """(id, nbr, sim) offers from blocks of rows next to each other: by the two axes of a random rotation that they lie
    closest to, then along one axis."""
    def spread(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vec, _ = _decoded(batch.column("code"), batch.column("scale"))
            for p in range(ROTATIONS):
                rng = np.random.default_rng(p)
                along = vec @ rng.standard_normal((vec.shape[1], AXES)).astype(np.float32)
                strong = np.argsort(-np.abs(along), axis=1)[:, :2]
                signs = np.take_along_axis(along, strong, 1) > 0
                cell = p
                for k in range(2):
                    cell = (cell * AXES + strong[:, k]) * 2 + signs[:, k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int64)), pa.array(along[:, 0].astype(np.float64)), batch.column("id"),
                     batch.column("code"), batch.column("scale")], names=["cell", "along", "id", "code", "scale"])

    def compare(batches):
        offers, held, size = Offers(), [], 0

        def block(part: pa.Table):
            ids = part.column("id").to_numpy()
            sims = _nearness(*_decoded(part.column("code").combine_chunks(), part.column("scale")))
            np.fill_diagonal(sims, -np.inf)
            keep = min(K // 2, len(ids) - 1)
            if keep > 0:
                near = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
                offers.add(np.repeat(ids, keep), ids[near].ravel(), np.take_along_axis(sims, near, 1).ravel())

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 8 * BLOCK:
                rows = pa.Table.from_batches(held)
                for a in range(0, size - 2 * BLOCK, BLOCK):
                    block(rows.slice(a, BLOCK))
                    done = a + BLOCK
                held = rows.slice(done).to_batches()
                size -= done
                if offers.size > _FLUSH:
                    yield offers.flush()
        if size:
            rows = pa.Table.from_batches(held)
            for a in range(0, size, BLOCK):
                block(rows.slice(a, BLOCK) if size - a > BLOCK // 2 or not a else rows.slice(max(0, size - BLOCK), BLOCK))
        if offers.held:
            yield offers.flush()

    rows = coded.mapInArrow(spread, "cell long, along double, id long, code binary, scale double")
    rows = rows.repartitionByRange("cell", "along", "id").sortWithinPartitions("cell", "along", "id")
    return rows.mapInArrow(compare, "id long, nbr array<long>, sim array<float>")


def _merge(offers: DataFrame, graph: DataFrame | None) -> DataFrame:
    """(id, nbr, sim, fresh): each node's best neighbours of its old list and all offers; fresh: not in the old list."""
    rows = offers.select("id", "nbr", "sim", F.lit(False).alias("old"))
    if graph is not None:
        rows = rows.union(graph.select("id", "nbr", "sim", F.lit(True)))

    def merge(batches):
        rest = None

        def out(t: pa.Table):
            sizes = np.diff(t.column("nbr").combine_chunks().offsets.to_numpy())
            node = np.repeat(t.column("id").to_numpy(), sizes)
            other = t.column("nbr").combine_chunks().flatten().to_numpy()
            score = t.column("sim").combine_chunks().flatten().to_numpy()
            known = np.repeat(t.column("old").to_numpy(zero_copy_only=False), sizes)
            pairs = np.stack([node[known], other[known]], axis=1)
            node, other, score = best(node, other, score, K)
            starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            lists = pa.array(np.concatenate([starts, [len(node)]]).astype(np.int32))
            if len(pairs):
                key = mixed(pairs[:, 0].astype(np.uint64)) ^ pairs[:, 1].astype(np.uint64)
                fresh = ~np.isin(mixed(node.astype(np.uint64)) ^ other.astype(np.uint64), key)
            else:
                fresh = np.ones(len(node), dtype=bool)
            return pa.RecordBatch.from_arrays(
                [pa.array(node[starts]), pa.ListArray.from_arrays(lists, pa.array(other)),
                 pa.ListArray.from_arrays(lists, pa.array(score)), pa.ListArray.from_arrays(lists, pa.array(fresh))],
                names=["id", "nbr", "sim", "fresh"])

        for batch in batches:  # sorted by id; the last id may go on in the next batch
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            ids = t.column("id").to_numpy()
            cut = int(np.searchsorted(ids, ids[-1])) if len(ids) else 0
            if cut:
                yield out(t.slice(0, cut).combine_chunks())
            rest = t.slice(cut)
        if rest is not None and rest.num_rows:
            yield out(rest.combine_chunks())

    return rows.repartition("id").sortWithinPartitions("id").mapInArrow(
        merge, "id long, nbr array<long>, sim array<float>, fresh array<boolean>")


def _round(graph: DataFrame, coded: DataFrame, turn: int) -> DataFrame:
    """Offers from all neighbourhoods that hold something new."""
    edges = graph.select("id", F.explode(F.arrays_zip("nbr", "fresh")).alias("e")).select(
        "id", F.col("e.nbr").alias("nbr"), F.col("e.fresh").alias("fresh"))
    listed = edges.groupBy("nbr").agg(F.count(F.lit(1)).alias("listed"))
    chance = F.pmod(F.xxhash64("id", "nbr", F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
    back = edges.join(listed, "nbr").where(chance * F.col("listed") < REVERSE).select(
        F.col("nbr").alias("center"), F.col("id").alias("member"), "fresh")
    members = edges.select(F.col("id").alias("center"), F.col("nbr").alias("member"), "fresh").union(back)
    worst = graph.select("id", F.when(F.size("sim") >= K, F.element_at("sim", -1)).otherwise(F.lit(float("-inf")))
                         .cast("float").alias("worst"))
    nodes = coded.join(worst, "id").withColumnRenamed("id", "member")
    met = members.groupBy("center", "member").agg(F.max("fresh").alias("fresh")).join(nodes, "member")

    def join(batches):
        offers, rest = Offers(), None

        def neighbourhood(ids, fresh, vec, added, worst):
            sims = _nearness(vec, added)
            useful = fresh[:, None] | fresh[None, :]
            np.fill_diagonal(useful, False)
            sims = np.where(useful & (sims > worst[:, None]), sims, -np.inf)
            keep = min(OFFERS, len(ids) - 1)
            near = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
            score = np.take_along_axis(sims, near, 1)
            row, col = np.nonzero(score > -np.inf)
            if len(row):
                offers.add(ids[row], ids[near[row, col]], score[row, col])

        def all_of(t: pa.Table):
            t = t.combine_chunks()
            center, ids = t.column("center").to_numpy(), t.column("member").to_numpy()
            fresh, worst = t.column("fresh").to_numpy(zero_copy_only=False), t.column("worst").to_numpy()
            vec, added = _decoded(t.column("code").combine_chunks(), t.column("scale"))
            starts = np.flatnonzero(np.concatenate([[True], center[1:] != center[:-1]]))
            for a, b in zip(starts, [*starts[1:], len(center)]):
                if b - a > 1 and fresh[a:b].any():
                    neighbourhood(ids[a:b], fresh[a:b], vec[a:b], added[a:b], worst[a:b])

        for batch in batches:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            ids = t.column("center").to_numpy()
            cut = int(np.searchsorted(ids, ids[-1])) if len(ids) else 0
            if cut:
                all_of(t.slice(0, cut))
            rest = t.slice(cut)
            if offers.size > _FLUSH:
                yield offers.flush()
        if rest is not None and rest.num_rows:
            all_of(rest)
        if offers.held:
            yield offers.flush()

    return met.repartition("center").sortWithinPartitions("center").mapInArrow(
        join, "id long, nbr array<long>, sim array<float>")


def build_graph(coded: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(id, nbr, sim, fresh): every node with its nearest neighbours found, nearest first."""
    graph = settle(_merge(_first_lists(coded), None), "graph")
    for turn in range(rounds):
        graph = settle(_merge(_round(graph, coded, turn), graph), "graph")
        tally = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x))).alias("new"), F.sum(F.size("nbr")).alias("all")).first()
        if (tally["new"] or 0) <= QUIET * (tally["all"] or 1):
            break
    return graph


def both_ways(graph: DataFrame) -> DataFrame:
    """(id, nbr): each node's neighbours, and of the nodes that list it as many as ``REVERSE`` on average at most."""
    edges = graph.select("id", F.explode("nbr").alias("nbr"))
    listed = edges.groupBy("nbr").agg(F.count(F.lit(1)).alias("listed"))
    chance = F.pmod(F.xxhash64("id", "nbr"), F.lit(1 << 20)) / float(1 << 20)
    back = edges.join(listed, "nbr").where(chance * F.col("listed") < REVERSE).select(F.col("nbr").alias("id"), F.col("id").alias("nbr"))
    return edges.union(back).groupBy("id").agg(F.collect_set("nbr").alias("nbr"))


_STATE = "query long, code binary, scale double, nbr array<long>, sim array<float>, opened array<boolean>, next array<long>, seen array<long>"


def search(graph: DataFrame, coded: DataFrame, starts: DataFrame, steps: int = STEPS) -> DataFrame:
    """(query, node): each query's list of nearest nodes found from its ``starts`` (query, code, scale, node list
    ``next``); ``graph``: (id, nbr).

    A query's state is one row: its list of at most ``BEAM`` nodes, which of them were expanded, and what was scored."""
    nodes = coded.select(F.col("id").alias("node"), F.col("code").alias("ncode"), F.col("scale").alias("nscale"))
    none = F.array().cast("array<bigint>")
    state = settle(starts.select(
        "query", "code", "scale", none.alias("nbr"), F.array().cast("array<float>").alias("sim"),
        F.array().cast("array<boolean>").alias("opened"), F.array_distinct("next").alias("next"), none.alias("seen")), "search")

    def step(scored: pa.Table, known: pa.Table) -> pa.Table:
        if not known.num_rows:
            return pa.Table.from_pylist([], schema=known.schema)
        old = {c: known.column(c)[0] for c in known.column_names}
        ids = np.array(old["nbr"].as_py(), dtype=np.int64)
        sims, done = np.array(old["sim"].as_py(), dtype=np.float32), np.array(old["opened"].as_py(), dtype=bool)
        seen = np.array(old["seen"].as_py(), dtype=np.int64)
        if scored.num_rows:
            found = scored.column("node").to_numpy()
            # The added component serves stored vectors only.
            ask = _decoded(known.column("code").combine_chunks(), known.column("scale"))[0][0]
            near = _decoded(scored.column("ncode").combine_chunks(), scored.column("nscale"))[0] @ ask
            ids, sims = np.concatenate([ids, found]), np.concatenate([sims, near.astype(np.float32)])
            done, seen = np.concatenate([done, np.zeros(len(found), dtype=bool)]), np.concatenate([seen, found])
        order = np.lexsort((ids, -sims))[:BEAM]
        ids, sims, done = ids[order], sims[order], done[order]
        pick = np.flatnonzero(~done)[:EXPAND]
        done[pick] = True
        return pa.table([known.column("query"), known.column("code"), known.column("scale"), *(
            pa.array([x], kind) for x, kind in ((ids, pa.list_(pa.int64())), (sims, pa.list_(pa.float32())),
                                                (done, pa.list_(pa.bool_())), (ids[pick], pa.list_(pa.int64())),
                                                (seen, pa.list_(pa.int64()))))], names=known.column_names)

    todo = state.select("query", F.explode("next").alias("node"))
    for turn in range(steps + 1):
        if turn:
            if state.where(F.size("next") > 0).isEmpty():
                break
            lists = state.select("query", F.explode("next").alias("id")).join(graph, "id").groupBy("query").agg(
                F.array_distinct(F.flatten(F.collect_list("nbr"))).alias("met"))
            todo = lists.join(state.select("query", "seen"), "query").select(
                "query", F.explode(F.array_except("met", "seen")).alias("node"))
        scored = todo.join(nodes, "node").select(F.col("query").alias("asker"), "node", "ncode", "nscale")
        state = settle(scored.groupBy("asker").cogroup(state.groupBy("query")).applyInArrow(step, _STATE), "search")
    return state.select("query", F.explode(F.slice("nbr", 1, EXACT)).alias("node"))


def nearest(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``rows`` (vec_id, embedding) that ``is_query`` marks, the ``k``
    nearest other rows found, by inner product of the original vectors, nearest first, ties to the smaller id.

    Null, zero or partly null or non-finite vectors take no part, nor those of an unusual length or a null id. A vec_id
    that occurs several times stands for the row whose vector sorts first. Fewer rows than ``k``: all are returned; an
    empty table gives an empty result."""
    vectors = settle(usable(rows).groupBy("id").agg(F.min("vec").alias("vec")), "vectors")
    coded = settle(_coded(vectors), "coded")
    graph = build_graph(coded)
    queries = vectors.withColumn("vec_id", F.col("id")).where(is_query).select("id")
    own = coded.join(queries, "id", "left_semi")
    # A query starts at its own node's list; nodes of a fixed small sample join them, so that no query is stuck, and the
    # longest ones, which few others list but many queries look for.
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    first = [coded.select("id").orderBy(F.xxhash64("id"), "id"), vectors.orderBy(length.desc(), "id").select("id")]
    fixed = F.array(*(F.lit(i) for i in sorted({r["id"] for rows in first for r in rows.limit(EXPAND).collect()})))
    ways = settle(both_ways(graph), "ways")
    starts = own.join(ways, "id", "left").select(F.col("id").alias("query"), "code", "scale", F.concat(
        F.coalesce("nbr", F.array().cast("array<bigint>")), fixed.cast("array<bigint>")).alias("next"))
    found = search(ways, coded, starts)
    pairs = found.where("query <> node").distinct()
    left = vectors.select(F.col("id").alias("query"), F.col("vec").alias("q"))
    right = vectors.select(F.col("id").alias("node"), F.col("vec").alias("v"))
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.join(left, "query").join(right, "node").select("query", "node", product.alias("score"))
    lists = scored.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("far"), "node", "score"))), 1, k).alias("l"))
    return lists.select(F.col("query").alias("query_id"), F.posexplode("l").alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.node").alias("vec_id"), F.col("x.score").alias("score"))


def op4_nn_descent(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
