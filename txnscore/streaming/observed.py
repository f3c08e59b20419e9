"""Stage counts of running streams (O32): observed metrics read by a listener.

A stream carries its counts with ``observe`` (no extra job); Spark reports them with
every micro-batch's progress and a ``StreamingQueryListener`` adds them up. The
stream runs in a session of its own, because in a session that ran an observed
query the ML evaluators cannot ship their closures (Spark 4.1).
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..schemas import LABEL

STAGES = "stages"


class StageCounts(StreamingQueryListener):
    """Adds up the observed counts of every micro-batch, per query."""

    def __init__(self):
        self._lock = threading.Lock()
        self._counts: dict[str, dict[str, int]] = {}
        self._batches: dict[str, set[int]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, query: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(query, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = p.observedMetrics.get(STAGES)
        if row is None:
            return
        with self._lock:
            seen = self._batches.setdefault(str(p.id), set())
            if p.batchId in seen:  # a batch reports once
                return
            seen.add(p.batchId)
            total = self._counts.setdefault(str(p.id), {})
            for name, n in row.asDict().items():
                total[name] = total.get(name, 0) + int(n or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.id)).set()

    def counts(self, query: StreamingQuery, timeout: float = 60.0) -> dict[str, int]:
        """Counts of an ended query, once its last event has come."""
        if not self._end(str(query.id)).wait(timeout):
            raise TimeoutError(f"no end of query {query.id} was reported")
        with self._lock:
            return dict(self._counts.get(str(query.id), {}))


def observed(stream: DataFrame, valid: Column, label: str = LABEL) -> DataFrame:
    """``stream`` with the stage counts observed on the way: input, valid, legit, fraud."""
    y, ok = F.col(label), F.coalesce(valid, F.lit(False))
    return stream.observe(STAGES, F.count(F.lit(1)).alias("input"), F.count(F.when(ok, 1)).alias("valid"),
                          F.count(F.when(ok & (y == 0), 1)).alias("legit"), F.count(F.when(ok & (y == 1), 1)).alias("fraud"))


def run_observed(spark: SparkSession, start: Callable[[SparkSession], StreamingQuery]) -> Mapping[str, int]:
    """Run the query that ``start`` begins in a session of its own until it ends;
    its stage counts."""
    own, listener = spark.newSession(), StageCounts()
    own.streams.addListener(listener)
    try:
        query = start(own)
        query.awaitTermination()
        return listener.counts(query)
    finally:
        own.streams.removeListener(listener)
