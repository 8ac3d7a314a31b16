"""Hard negatives by exact integer scores from a residue number system.

Vectors are rounded to integers. A score is an inner product of integers, which float32 products cannot hold; so the
component matrices are reduced modulo several small primes, multiplied modulo each in float32, where every sum stays
below 2^24 and is exact, and the exact signed scores are put together from the residues by Chinese remaindering. There
are as many primes as the longest vectors need (Cauchy-Schwarz).

Anchors are cut into blocks and rows into stripes; every block meets every stripe in a task of its own, which holds a
block, a stripe and some products and sends on each anchor's best rows only. The first meeting multiplies rows of equal
label and finds the positives; the second multiplies those of other labels and takes, for each positive, the rows whose
score falls into a window below the positive's."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.llm.common import settle, table

POSITIVES, NEGATIVES = 5, 5
#: A negative has so many to so many hundredths of its positive's score.
WINDOW = (80, 100)
SCALE = 256
#: Components of a block of anchors and of a stripe; a stripe has fewer if that keeps all tasks busy, but not under the
#: least number of rows.
ANCHORS, STRIPE, LEAST = 1 << 17, 1 << 22, 512
#: Anchors, and rows of a stripe, that are multiplied at once.
COLUMNS = 1024
#: Primes under 256, largest first: balanced residues are at most 125, and 1024 products of two stay below 2^24.
PRIMES = [p for p in range(255, 100, -1) if all(p % q for q in range(2, 16))]
DIMENSIONS = 1024
_NO_ID = np.iinfo(np.int64).max


def primes_for(bound: int) -> list[int]:
    """Enough primes to tell all integers from ``-bound`` to ``bound`` apart."""
    chosen, product = [], 1
    for prime in PRIMES:
        if product > 2 * bound:
            break
        chosen.append(prime)
        product *= prime
    return chosen


def _balanced(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues from -(prime // 2) to prime // 2."""
    return (values + prime // 2) % prime - prime // 2


class Residues:
    """An integer matrix modulo each prime, in float32."""

    def __init__(self, matrix: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [_balanced(matrix, p).astype(np.float32) for p in primes]

    def __getitem__(self, rows) -> Residues:
        out = Residues.__new__(Residues)
        out.primes, out.parts = self.primes, [x[rows] for x in self.parts]
        return out

    def times(self, other: Residues) -> np.ndarray:
        """Exact inner products of all rows of both as int64: from the residues of the products, one digit per prime in
        mixed radix, each balanced, so the sign comes out by itself."""
        digits: list[np.ndarray] = []
        for k, prime in enumerate(self.primes):
            left, right = self.parts[k], other.parts[k]
            residue = np.zeros((len(left), len(right)), dtype=np.int64)
            for a in range(0, left.shape[1], DIMENSIONS):
                residue += (left[:, a:a + DIMENSIONS] @ right[:, a:a + DIMENSIONS].T).astype(np.int64)
            for digit, smaller in zip(digits, self.primes):
                residue = (residue - digit) % prime * pow(smaller, -1, prime)
            digits.append(_balanced(residue, prime))
        total = np.zeros((len(self.parts[0]), len(other.parts[0])), dtype=np.int64) if not digits else digits[-1]
        for digit, prime in zip(digits[-2::-1], self.primes[-2::-1]):
            total = total * prime + digit
        return total


class Rows:
    """A table's ids, labels and vectors, ordered by label and id; shorter vectors are filled up with zeros."""

    def __init__(self, rows: pa.Table, width: int, primes: list[int]):
        vectors = rows.column("vec").combine_chunks()
        sizes = np.diff(vectors.offsets.to_numpy())
        matrix = np.zeros((len(vectors), width), dtype=np.int64)
        matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = \
            vectors.flatten().to_numpy()
        self.row, self.label = (rows.column(c).to_numpy() for c in ("row", "label"))
        self.id = rows.column("vec_id").fill_null(_NO_ID).to_numpy()
        self.order = np.lexsort((self.row, self.id, self.label))
        self.row, self.label, self.id = self.row[self.order], self.label[self.order], self.id[self.order]
        self.vectors = Residues(matrix[self.order], primes)

    def labels(self):
        """(label, its first place, the place behind its last)."""
        values, starts = np.unique(self.label, return_index=True)
        return zip(values.tolist(), starts.tolist(), [*starts[1:].tolist(), len(self.label)])


def _best(score: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` highest scores, ties to the smaller id."""
    if len(score) > 4 * keep:
        least = np.partition(score, len(score) - keep)[len(score) - keep]
        among = np.flatnonzero(score >= least)
        return among[np.lexsort((ids[among], -score[among]))[:keep]]
    return np.lexsort((ids, -score))[:keep]


def _found(schema: str, columns) -> pa.Table:
    columns = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in columns]
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.table({n: pa.array(c, pa.int64(), mask=(c == _NO_ID) if n == "vec_id" else None) for n, c in zip(names, columns)})


_POSITIVES = "anchor long, vec_id long, score long, row long"
_NEGATIVES = "anchor long, nth long, vec_id long, score long"


def _positives_of(width: int, primes: list[int]):
    def run(_, left, right):
        out: list[list[np.ndarray]] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            anchors, rows = Rows(left, width, primes), Rows(right, width, primes)
            places = {label: (a, b) for label, a, b in rows.labels()}
            for label, start, end in anchors.labels():
                if label not in places:
                    continue
                first, last = places[label]
                held = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * (end - start)
                for a in range(first, last, COLUMNS):
                    b = min(a + COLUMNS, last)
                    scores = anchors.vectors[start:end].times(rows.vectors[a:b])
                    for i, (place, score) in enumerate(held):
                        place = np.concatenate([place, np.arange(a, b)])
                        score = np.concatenate([score, scores[i]])
                        other = rows.row[place] != anchors.row[start + i]
                        place, score = place[other], score[other]
                        top = _best(score, rows.id[place], POSITIVES)
                        held[i] = place[top], score[top]
                for i, (place, score) in enumerate(held, start):
                    for column, values in zip(out, (np.full(len(place), anchors.row[i]), rows.id[place], score, rows.row[place])):
                        column.append(values)
        return _found(_POSITIVES, out)
    return run


def _negatives_of(width: int, primes: list[int]):
    def run(_, left, right):
        out: list[list[np.ndarray]] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            anchors, rows = Rows(left, width, primes), Rows(right, width, primes)
            # Bounds of each positive's window, in whole scores.
            bounds = []
            for i in anchors.order.tolist():
                high = np.array(left.column("positives")[i].as_py(), dtype=object)
                bounds.append([(int(-(-h * WINDOW[0] // 100)), int(h * WINDOW[1] // 100)) for h in high])
            held = {(i, k): (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
                    for i in range(len(bounds)) for k in range(len(bounds[i]))}
            for a in range(0, len(rows.id), COLUMNS):
                b = min(a + COLUMNS, len(rows.id))
                scores = anchors.vectors.times(rows.vectors[a:b])
                for i, windows in enumerate(bounds):
                    low, high = min(x for x, _ in windows), max(x for _, x in windows)
                    fit = np.flatnonzero((scores[i] >= low) & (scores[i] <= high) & (rows.label[a:b] != anchors.label[i]))
                    own, ids = scores[i][fit], rows.id[a + fit]
                    for k, (low, high) in enumerate(windows):
                        inside = (own >= low) & (own <= high)
                        if inside.any():
                            ident, score = held[i, k]
                            ident = np.concatenate([ident, ids[inside]])
                            score = np.concatenate([score, own[inside]])
                            top = _best(score, ident, NEGATIVES)
                            held[i, k] = ident[top], score[top]
            for (i, k), (ident, score) in held.items():
                for column, values in zip(out, (np.full(len(ident), anchors.row[i]), np.full(len(ident), k), ident, score)):
                    column.append(values)
        return _found(_NEGATIVES, out)
    return run


def _meet(anchors: DataFrame, rows: DataFrame, blocks: int, stripes: int, run, schema: str) -> DataFrame:
    """``run`` over every pair of a block of ``anchors`` and a stripe of ``rows``; both have their number in ``part``."""
    left = anchors.withColumnRenamed("part", "block").withColumn("stripe", F.explode(F.expr(f"sequence(0, {stripes - 1})")))
    right = rows.withColumnRenamed("part", "stripe").withColumn("block", F.explode(F.expr(f"sequence(0, {blocks - 1})")))
    return left.groupBy("block", "stripe").cogroup(right.groupBy("block", "stripe")).applyInArrow(run, schema)


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vec): components times ``scale``, rounded down, of the rows with a label and finite components."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), vec.alias("vec")).where(
        F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad).withColumn(
        "vec", F.transform("vec", lambda x: F.floor(x * float(scale))))


def mine_negatives(rows: DataFrame, anchors) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows (vec_id, label, vec) of
    which the condition ``anchors`` is true, mined among all ``rows``; vectors are arrays of bigint.

    An anchor's positives are the rows of its label with the highest scores, itself excluded; a positive's negatives are
    the rows of other labels with the highest scores within the window; a positive below zero has an empty window. Ties
    go to the smaller vec_id, a null vec_id comes last. A repeated row counts as often as it is there: its repeat is
    another row and may be its positive, and an anchor that is there twice returns its rows twice. A vector that is
    shorter than the longest has zeros for the rest. A null label or vector takes no part; an empty table gives an empty
    result. Scores of 2^62 or more would not fit the result: vectors that long are an ``OverflowError``."""
    spark = rows.sparkSession
    usable = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull())
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    given = settle(usable.select("vec_id", "label", "vec", F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
                                 square.alias("square"), F.monotonically_increasing_id().alias("row")), "vectors")
    most = given.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("is_anchor").cast("bigint")), F.lit(0)).alias("anchors"),
                     F.max("square").alias("square"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width")).first()
    longest = int((most["square"] or 0.0) * (1 + 1e-6)) + 1
    if longest >= 1 << 62:
        raise OverflowError("inner products of these vectors don't fit 64 bits")
    primes, width = primes_for(longest), most["width"]
    busy = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = max(1, -(-most["anchors"] * width // ANCHORS), -(-most["anchors"] // COLUMNS))
    stripes = max(-(-most["rows"] * width // STRIPE), min(-(-busy // blocks), most["rows"] // LEAST), 1)
    stored = given.select("row", "vec_id", "label", F.col("vec").cast("array<int>").alias("vec"), "is_anchor")
    striped = stored.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int")).drop("is_anchor")
    asked = stored.where("is_anchor").withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")).drop("is_anchor")
    near = _meet(asked, striped, blocks, stripes, _positives_of(width, primes), _POSITIVES)
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    near = near.withColumn("nth", F.row_number().over(best) - 1).where(F.col("nth") < POSITIVES)
    near = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near"))
    asked = settle(asked.join(near, F.col("row") == F.col("anchor")).drop("anchor"), "anchors")
    low = _meet(asked.select("row", "vec_id", "label", "vec", "part", F.col("near.score").alias("positives")), striped, blocks, stripes,
                _negatives_of(width, primes), _NEGATIVES)
    ranked = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    low = low.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= NEGATIVES)
    named = asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "near")
    positive = F.element_at("near", F.col("nth").cast("int") + 1)
    return low.join(named, "anchor").select(
        "anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def op11_residue_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(whole_vectors(rows.withColumn("label", label)), F.col("vec_id") % 100 == 0)


#: The same by all pairs of anchors and rows.
ORACLE = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as vec
    from embeddings where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
pairs as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
           cast(list_dot_product(a.vec, r.vec) as bigint) as score
    from rows a, rows r where a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over best as integer) as rank, n.vec_id as negative_id,
       p.positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
    and 80 * p.positive_score <= 100 * n.score and 100 * n.score <= 100 * p.positive_score
window best as (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)
qualify row_number() over best <= 5"""
