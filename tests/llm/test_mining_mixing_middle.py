"""Hard negatives, source mixing and fill-in-the-middle against brute force, on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import cube_mixing, fenwick_middle, residue_negatives
from orderloom.llm.common import ship_package

RNG = np.random.default_rng(11)


# Hard negatives

def test_residue_products_are_exact():
    for size, width in ((3, 1), (1000, 64), (30000, 2500)):
        left, right = (RNG.integers(-size, size, (n, width)) for n in (7, 9))
        left[0], right[0], right[1] = size, size, -size  # as far out as they can be, both ways
        primes = residue_negatives.primes_for(width * size * size)
        assert math.prod(primes) > 2 * width * size * size
        exact = left.astype(object) @ right.T.astype(object)
        got = residue_negatives.Residues(left, primes).times(residue_negatives.Residues(right, primes))
        assert (got.astype(object) == exact).all()


def brute_negatives(rows, is_anchor):
    """rows: (vec_id, label, ints), as the docstring has it."""
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, label, list(v) + [0] * (width - len(v))) for i, label, v in rows]
    key = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for a, (anchor, label, vec) in enumerate(rows):
        if not is_anchor(anchor):
            continue
        scored = [(i, sum(x * y for x, y in zip(vec, v)), other) for k, (i, other, v) in enumerate(rows) if k != a]
        positives = sorted(((i, s) for i, s, other in scored if other == label), key=key)[:5]
        for positive, high in positives:
            fit = sorted(((i, s) for i, s, other in scored if other != label and 80 * high <= 100 * s <= 100 * high), key=key)[:5]
            out += [(anchor, positive, k, i, high, s) for k, (i, s) in enumerate(fit, 1)]
    return Counter(out)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(residue_negatives, "ANCHORS", 40)
    monkeypatch.setattr(residue_negatives, "STRIPE", 300)
    monkeypatch.setattr(residue_negatives, "COLUMNS", 7)
    monkeypatch.setattr(residue_negatives, "LEAST", 20)


def test_negatives_against_all_pairs(spark, small_blocks):
    ship_package(spark)
    vectors = RNG.normal(size=(160, 6))
    vectors[30:45] = vectors[30]  # ties
    rows = [(i, int(RNG.integers(0, 3)) if i % 5 else 0, v.tolist(), "x", 1) for i, v in enumerate(vectors)]
    rows += [rows[20], rows[30], rows[30]]  # repeated rows
    rows += [(None, 1, vectors[3].tolist(), None, None), (400, None, [1.0] * 6, None, 2), (420, 1, None, None, 3),
             (440, 1, [1.0, None] * 3, "", 4), (460, 2, [float("nan")] * 6, "", 5), (480, 2, [float("-inf")] * 6, "", 6),
             (500, 2, [3.0, 1.5], "short", 7), (520, 0, [], "", 8), (540, 0, [0.0] * 6, "", 9)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, row string, anchor int").repartition(4)
    whole = residue_negatives.whole_vectors(frame)
    got = residue_negatives.mine_negatives(whole, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    usable = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v, *_ in rows
              if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert {i for i, *_ in usable} >= {500, 520, 540, None}
    assert Counter(map(tuple, got.collect())) == brute_negatives(usable, lambda i: i is not None and i % 10 == 0)


def test_negatives_of_few_rows(spark):
    ship_package(spark)
    frame = spark.createDataFrame([(0, 1, [1.0, 1.0]), (1, 1, [2.0, 1.0]), (2, 2, [1.0, 1.5])], "vec_id long, label int, embedding array<float>")
    whole = residue_negatives.whole_vectors(frame)
    assert [tuple(r) for r in residue_negatives.mine_negatives(whole, F.col("vec_id") == 0).collect()] == [
        (0, 1, 1, 2, 3 * 65536, 163840)]
    assert residue_negatives.mine_negatives(whole, F.lit(False)).count() == 0
    assert residue_negatives.mine_negatives(whole.limit(0), F.lit(True)).count() == 0
    with pytest.raises(OverflowError):
        residue_negatives.mine_negatives(residue_negatives.whole_vectors(frame, scale=1 << 40), F.lit(True))


# Mixing

def test_flight_keeps_both_totals():
    for sizes in ([5] * 40, [0] * 9, list(RNG.integers(0, 30, 300)), [20000, 3, 2], [20000, 3, 2, 1], [1, 1], [7], [],
                  sorted(RNG.pareto(1.0, 400).astype(int) + 1, reverse=True)):
        sizes = np.array(sizes, dtype=np.int64)
        chances = RNG.random(len(sizes)).round(2)
        out = cube_mixing.flight(sizes, chances, cube_mixing.Draws("a", len(sizes)))
        assert ((out > 0) & (out < 1)).sum() <= 2 and ((out >= 0) & (out <= 1)).all()
        assert out.sum() == pytest.approx(chances.sum(), abs=1e-6)
        assert (out * sizes).sum() == pytest.approx((chances * sizes).sum(), rel=1e-6, abs=1e-6)
        landed = cube_mixing.flight(sizes, chances, cube_mixing.Draws("b"), land=True)
        assert set(landed.tolist()) <= {0.0, 1.0}
        assert abs(landed.sum() - chances.sum()) < 3


def test_inclusion_probabilities_are_kept():
    sizes = np.array([900, 400, 90, 80, 30, 12, 11, 5, 5, 1])
    chances = np.array([0.3, 0.3, 0.3, 0.7, 0.7, 0.5, 0.2, 0.2, 0.9, 0.4])
    mean = np.mean([cube_mixing.flight(sizes, chances, cube_mixing.Draws("run", k), land=True) for k in range(4000)], axis=0)
    assert np.abs(mean - chances).max() < 0.04  # five standard errors


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Deals by weight again and again, as the words of the contract have it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), list(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in open_)
        for s in open_:
            target[s] = min(target[s], float(most * sizes[s]))
        open_ = [s for s in open_ if target[s] < most * sizes[s]]
    return target


def mixing_rows():
    words = ["a", "bb", "ccc\n", "\x1cd"]
    rows = []
    for i in range(900):
        source = ("s0", "s1", "s1", "s1", "s10", "\U0001f600", "～", None)[i % 8] if i < 700 else "s0"
        n = 0 if i % 50 == 0 else 400 if i in (7, 701) else int(RNG.integers(1, 60))
        rows.append((i, None if i % 100 == 0 else " ".join(RNG.choice(words, n)) + " \n", source, i, "x"))
    rows += [rows[5]] * 40 + [(None, "one two three", "s1", 1, None)] * 30 + [(None, None, None, None, None), (5000, " \t", "empty", 1, "")]
    return rows


def test_mix_against_targets(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(cube_mixing, "CHUNK", 64)
    monkeypatch.setattr(cube_mixing, "MEET", 4)
    rows = mixing_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target string")
    got = cube_mixing.mix_sources(frame.repartition(3))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    found = [tuple(r) for r in got.collect()]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += count(text)
    target = brute_targets(sizes)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert any(target[s] == 2 * sizes[s] > 0 for s in sizes) and any(0 < target[s] < 2 * sizes[s] for s in sizes)
    given = Counter((i, count(text), sizes[source]) for i, text, source, *_ in rows)
    assert Counter(r[:3] for r in found) == given
    by_size = {sizes[s]: s for s in sizes}
    assert len(by_size) == len(sizes)
    taken, documents = defaultdict(int), Counter()
    for i, size, source_size, aim, words in found:
        source = by_size[source_size]
        assert aim == pytest.approx(target[source])
        often = target[source] / source_size if source_size else 0
        assert words in {size * math.floor(often + 1e-9), size * math.ceil(often - 1e-9)} and words <= 2 * size
        taken[source] += words
        documents[source] += 1
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 60, source  # though two documents have 400 words
    again = cube_mixing.mix_sources(frame.repartition(7).orderBy(F.desc("doc_id")))
    assert Counter(map(tuple, again.collect())) == Counter(found)


def test_mix_of_little(spark):
    ship_package(spark)
    frame = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert sorted(map(tuple, cube_mixing.mix_sources(frame).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert cube_mixing.mix_sources(frame.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a b c d", None)], "doc_id long, text string, source string")
    [row] = cube_mixing.mix_sources(one).collect()
    assert row["target"] == 6.0 and row["taken"] in (4, 8)


# Fill-in-the-middle

def brute_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def middle_texts():
    alphabet = list("aZb.<P S>M>\n\té語\U0001f600") + ["word", "<", "S>", "M>"]
    texts = [None, "", "a", "é", "word", "x" * 5000, "語" * 3000, "a<P>b", "<S>", "<M>", "<<P", "S><", "M>", " \r\n\x85 ",
             "\x00a\x00"]
    texts += ["".join(RNG.choice(alphabet, n)) for n in RNG.integers(1, 40, 150)]
    texts += ["".join(RNG.choice(["lorem ", "ipsum\n", "x" * 700, "語", "\U0001f600"], n)) for n in (300, 900, 3000)]
    return texts


def test_middle_against_lists_of_units(spark, monkeypatch):
    ship_package(spark)
    texts = middle_texts()
    rows = [(i, t, i, "z") for i, t in enumerate(texts)] + [(None, "some text", 1, None), (3, texts[3], 3, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long, form string").repartition(3)
    moved = fenwick_middle.fill_in_middle(frame.select("doc_id", "text", "n", "form"))
    got = moved.withColumn("back", fenwick_middle.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r["doc_id"], *r[1:6]) for r in got) == Counter((i, *brute_middle(i, t)) for i, t, *_ in rows)
    given = {i: t or "" for i, t, *_ in rows}
    assert all(r["back"] == given[r["doc_id"]] for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    kept = fenwick_middle.fill_in_middle(frame.withColumnRenamed("n", "text2").withColumn("cut", F.lit(1)), ("doc_id", "text", "cut"))
    assert kept.columns == ["doc_id", "text", "cut", "n", "form", "prefix_chars", "middle_chars", "output"] and kept.count() == len(rows)
    assert fenwick_middle.fill_in_middle(frame.limit(0)).count() == 0


def test_tree_finds_every_unit(monkeypatch):
    monkeypatch.setattr(fenwick_middle, "BLOCK", 8)
    monkeypatch.setattr(fenwick_middle, "COUNTED", 24)
    for text in middle_texts()[1:40] + ["ab" * 100 + ".", "語x" * 90]:
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        tree = fenwick_middle.BlockTree(np.frombuffer(text.encode(), dtype=np.uint8))
        assert tree.total == len(units)
        ends = [0, *np.cumsum([len(u) for u in units]).tolist()]
        assert [tree.points_before(k) for k in range(len(units) + 1)] == ends
