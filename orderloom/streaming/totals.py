"""Totals of a stream's run, told when it ends."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

COUNTERS = ("consumed", "inserted", "invalid", "failed")
Totals = dict[str, int | float | str | None]

_log = logging.getLogger("orderloom.ingest")


def log_totals(totals: Totals) -> None:
    _log.info("stopped after %(batches)d batches: consumed %(consumed)d, inserted %(inserted)d, invalid %(invalid)d, "
              "failed %(failed)d, %(success_rate).1f %% stored; error: %(error)s", totals)


class RunTotals(StreamingQueryListener):
    """Adds up the batches of one query from its start and reports when it ends, by a stop, an error or the end of its
    input. What the query did in earlier runs is not in it; ``ingest_totals`` over the stored metrics has all of them.

    The batches run in one thread and the end is told in another; ``ended`` is set when it was reported."""

    def __init__(self, spark: SparkSession, report: Callable[[Totals], None] = log_totals):
        self.ended = threading.Event()
        self._spark, self._report, self._run = spark, report, None
        self._sums, self._batches, self._lock = dict.fromkeys(COUNTERS, 0), 0, threading.Lock()

    def add(self, counts: dict[str, int]) -> None:
        """Take in one batch, or the failure of one."""
        with self._lock:
            self._batches += "consumed" in counts
            for name, number in counts.items():
                self._sums[name] += number

    def totals(self, error: str | None = None) -> Totals:
        with self._lock:
            sums, batches = dict(self._sums), self._batches
        rate = sums["inserted"] * 100.0 / sums["consumed"] if sums["consumed"] else 0.0
        return {**sums, "success_rate": rate, "batches": batches, "error": error}

    def watch(self, query: StreamingQuery) -> StreamingQuery:
        """Report the end of ``query``, also where it came before this call."""
        self._run = str(query.runId)
        self._spark.streams.addListener(self)
        if not query.isActive:
            self._end(str(query.exception()) if query.exception() else None)
        return query

    def _end(self, error: str | None) -> None:
        with self._lock:
            if self.ended.is_set():
                return
            self.ended.set()
        self._report(self.totals(error))
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self._end(event.exception)
