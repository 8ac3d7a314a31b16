"""Nearest neighbours, chat logs and the pipeline, on small tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import chat_events, nn_descent
from orderloom.llm.common import settle, ship_package

RNG = np.random.default_rng(5)


def test_nearest_neighbours(spark):
    ship_package(spark)
    vectors = RNG.normal(size=(1500, 16)) * RNG.uniform(0.5, 2.0, size=(1500, 1))
    vectors[40:60] = vectors[40]  # copies: ties go to the smaller id
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    bad = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [1.0, None] * 8), (2080, [1.0]),
           (None, [1.0] * 16), (2100, [float("inf")] * 16)]
    frame = spark.createDataFrame([*rows, *((i, v, "x") for i, v in bad), rows[7]],
                                  "vec_id long, embedding array<double>, id string")
    got = defaultdict(list)
    for r in nn_descent.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(1500), -scores))[:20]
        hits += len(set(best.tolist()) & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        assert all(s == pytest.approx(scores[v], rel=1e-12) for _, v, s in found)
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
    assert hits / (20 * len(got)) >= 0.95
    few = nn_descent.nearest(frame.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]
    assert nn_descent.nearest(frame.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("lengths", ["one very long", "heavy tail"])
def test_nearest_neighbours_of_unequal_lengths(spark, lengths):
    ship_package(spark)
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if lengths == "one very long":
        vectors[7] *= 300
    else:
        vectors *= np.exp(1.2 * rng.normal(size=(3000, 1)))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in nn_descent.nearest(frame, F.col("vec_id") % 40 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in range(0, 3000, 40):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & got[q])
    assert hits / (20 * len(got)) >= 0.95


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [(1, 5, 0, "delta", None, "lo"), (1, 1, 0, "start", "user", None), (1, 4, 0, "delta", None, "Hel"),
           (1, 6, 1, "start", "assistant", None), (1, 7, 1, "delta", None, "bad"), (1, 8, 1, "regenerate", None, None),
           (1, 9, 1, "delta", None, "go"), (1, 10, 1, "delta", None, "od"), (1, 10, 1, "delta", None, "od"),
           (1, 11, 2, "delta", "user", "x"), (1, 12, 2, "edit", None, "y"), (1, 13, 2, "delta", None, None),
           (None, 1, 0, "start", "system", None)]
    events = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string")
    got = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in chat_events.fold_messages(events).collect()}
    assert got == {(1, 0): ("user", "Hello"), (1, 1): ("assistant", "good"), (1, 2): ("user", "y"), (None, 0): ("system", "")}
    shown = {r["conv_id"]: r for r in chat_events.format_conversations(events).collect()}
    assert shown[1]["formatted"] == "<turn user>\nHello</turn>\n<turn assistant>\ngood</turn>\n<turn user>\ny</turn>\n"
    at = shown[1]["loss_spans"][0]
    assert shown[1]["formatted"][at["start"] - 1:at["start"] - 1 + at["length"]] == "good" and not shown[None]["loss_spans"]
    assert chat_events.format_conversations(events.limit(0)).count() == 0


def test_conversations_come_back(spark):
    nasty = ["", None, "\\", "\\0<\\1>\\2", "</turn>\n<turn user>\nx", "é \U0001f600 <", ">\n", "\\### Assistant: </turn> ok"]
    rows = [(c, t, RNG.choice(["user", "assistant", "a>\nb"]).item(), nasty[RNG.integers(len(nasty))])
            for c in range(12) for t in range(int(RNG.integers(1, 9)))]
    rows += [(3, 0, "user", "tie"), (3, 0, "user", "tie"), (None, None, None, None)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, seq long")
    formatted = settle(chat_events.format_conversations(chat_events.events_of(frame)), "formatted")
    got = {r["conv_id"]: r for r in chat_events.read_back(formatted).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        lines = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_pipeline_stages(spark, tmp_path):
    def text(n):
        return " ".join("".join(RNG.choice(["the", "tion", "ing", "shan", "wher", "ond", "er"], RNG.integers(1, 4))) for _ in range(n))

    clean = [(i, text(int(RNG.integers(30, 200))), "en", f"s{i % 2}", 1) for i in range(60)]
    copies = [(100, clean[3][1], "en", "s1", 1), (101, clean[3][1] + " more", "en", "s0", 1), clean[5]]
    junk = [(200, "123 !!", "en", "s0", 1), (201, None, "en", "s0", 1), (202, " ".join(["same words over and over again"] * 20), "en", "s0", 1),
            (203, "too short", "en", "s0", 1)]
    rows = clean + copies + junk
    folder = tmp_path / "sf"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(folder / "documents.parquet"))
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "near_duplicates", "packing"]
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, str(folder)), name)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        kept.append(Counter(r["doc_id"] for r in docs.collect()))
    everything = Counter(r[0] for r in rows)
    assert everything - kept[0] == Counter([200, 201])
    assert kept[0] - kept[1] == Counter([202, 203])
    assert kept[1] - kept[2] == Counter([100, 101, 5])
    packed = corpus_pipeline.run(spark, str(folder)).collect()
    assert {r["doc_id"] for r in packed} == {r[0] for r in clean}
    assert all(sum(p["length"] for p in packed if p["doc_id"] == r["doc_id"]) == r["doc_tokens"] for r in packed)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(folder)).count() == 0
