"""Compaction of the per-batch tables: the same rows from fewer files, at every moment."""

import datetime as dt

import pytest

from orderloom.plans.rollup import last_batch
from orderloom.schemas import BATCH_METRICS, TOUCHED_DATES, ddl
from orderloom.session import shared_folder
from orderloom.sinks import generations
from orderloom.sinks.warehouse import Warehouse


@pytest.fixture
def store(spark):
    made = Warehouse(spark, shared_folder(spark, "generations")).create()
    made.noted = 0
    return made


def note(store, number=20, stream="q-a"):
    """The metrics and dates of some batches, as the ingest writes them; every third batch has no dates."""
    for n in range(store.noted, store.noted + number):
        label, when = f"{stream}-{n}", dt.datetime(2024, 5, 5, n % 24)
        store.replace_partition("batch_metrics", label, store.spark.createDataFrame(
            [(n, 10, 8, 2, 0, when, label)], ddl(BATCH_METRICS)).coalesce(1))
        dates = [(dt.date(2024, 5, 1 + n % 5), n + 1, label)] if n % 3 else []
        store.replace_partition("touched_dates", label, store.spark.createDataFrame(dates, ddl(TOUCHED_DATES)).coalesce(1))
    store.noted += number


def rows(store, table):
    return sorted((tuple(r) for r in store.read(table).collect()), key=str)


def test_the_same_rows_from_fewer_files(store):
    note(store)
    before = {table: rows(store, table) for table in generations.COMPACTED}
    seq = last_batch(store.read("touched_dates"))
    assert len(store.read("batch_metrics").inputFiles()) == 20
    assert generations.fold_batches(store, 10) == ["rejects", "batch_metrics", "touched_dates"][1:]
    assert {table: rows(store, table) for table in generations.COMPACTED} == before
    assert store.read("batch_metrics").schema == Warehouse(store.spark, store.root).read("batch_metrics").schema
    assert last_batch(store.read("touched_dates")) == seq
    # What was folded lies there for queries already planned, and goes with the next fold.
    assert len(store.names(store.path("batch_metrics"))) >= 20
    note(store)
    now = {table: rows(store, table) for table in generations.COMPACTED}
    assert generations.fold(store, "batch_metrics", 10)
    assert rows(store, "batch_metrics") == now["batch_metrics"] and len(now["batch_metrics"]) == 40
    left = [n for n in store.names(store.path("batch_metrics")) if n.startswith("ingest_batch=")]
    assert len(left) == 21 and len(store.names(f"{store.path('batch_metrics')}_generations")) >= 4


def test_the_last_batch_stays_and_may_be_repeated(store):
    assert generations.closed_batches(["a-b-0", "a-b-1", "a-b-10", "a-b-9", "c-3", "free", "x-y", "7"]) == [
        "a-b-0", "a-b-1", "a-b-9"]
    note(store, 5)
    assert generations.fold(store, "batch_metrics", 2)
    assert not generations.fold(store, "batch_metrics", 0)
    again = store.spark.createDataFrame([(4, 99, 1, 98, 1, None, "q-a-4")], ddl(BATCH_METRICS))
    store.replace_partition("batch_metrics", "q-a-4", again)
    found = {r["batch_id"]: r["consumed"] for r in store.read("batch_metrics").collect()}
    assert found == {0: 10, 1: 10, 2: 10, 3: 10, 4: 99}


def test_generations_are_merged_by_level(store):
    for _ in range(9):
        note(store, 2)
        assert generations.fold(store, "batch_metrics", 0, fan_in=3)
        names = generations.notice(store, "batch_metrics")["generations"]
        assert all(sum(n.endswith(f"l{level}") for n in names) < 3 for level in range(3))
    assert names == ["g9l2"] and len(rows(store, "batch_metrics")) == 18
    note(store, 2)
    assert generations.fold(store, "batch_metrics", 0, fan_in=3)
    folders = [n for n in store.names(f"{store.path('batch_metrics')}_generations") if n.startswith("g")]
    assert sorted(folders) == ["g10l0", "g9l2"] and len(rows(store, "batch_metrics")) == 20


@pytest.mark.parametrize("step", ["write_text", "rename", "drop_partition"])
def test_a_fold_that_is_cut_off(store, monkeypatch, step):
    note(store, 6)
    generations.fold(store, "batch_metrics", 1)
    note(store, 6)
    before = rows(store, "batch_metrics")

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            generations.fold(store, "batch_metrics", 1)
        assert rows(store, "batch_metrics") == before
    assert generations.fold(store, "batch_metrics", 1) and rows(store, "batch_metrics") == before
