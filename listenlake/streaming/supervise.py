"""Watching over the streaming queries of a session: progress to the log, failures at once."""

from __future__ import annotations

import logging
from collections import defaultdict
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger("listenlake.streams")


@dataclass
class Totals:
    """What a query has done since it was watched."""

    batches: int = 0
    rows: int = 0
    late_rows: int = 0
    rows_a_second: float = 0.0
    failure: str | None = None


class StreamWatch(StreamingQueryListener):
    """Progress of every query of a session, to the log and in ``totals`` by query id.

    ``late_rows`` are those that came after their watermark and were left out by a stateful step.
    """

    def __init__(self) -> None:
        self.totals: dict[str, Totals] = defaultdict(Totals)
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:
        log.info("%s started, run %s", event.name or event.id, event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        with self._lock:
            seen = self.totals[str(progress.id)]
            seen.batches += 1
            seen.rows += progress.numInputRows
            seen.late_rows += late
            seen.rows_a_second = progress.processedRowsPerSecond
        behind = {k: v for source in progress.sources for k, v in (source.metrics or {}).items() if "Behind" in k}
        log.info(
            "%s batch %d: %d rows, %.0f a second, %d late%s",
            progress.name or progress.id,
            progress.batchId,
            progress.numInputRows,
            progress.processedRowsPerSecond,
            late,
            f", behind by {behind}" if behind else "",
        )

    def onQueryIdle(self, event) -> None:
        log.debug("%s has nothing to do", event.id)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self.totals[str(event.id)].failure = event.exception
        if event.exception:
            log.error("%s failed: %s", event.id, event.exception.splitlines()[0])
        else:
            log.info("%s ended", event.id)


def supervise(spark: SparkSession, queries: list[StreamingQuery], watch: StreamWatch | None = None) -> None:
    """Wait until all ``queries`` have ended; the first failure stops the others at once and is raised.

    Spark wakes the caller when any query ends; nothing is polled. ``watch``, if given, hears of
    their progress meanwhile.
    """
    if watch is not None:
        spark.streams.addListener(watch)
    try:
        while True:
            spark.streams.resetTerminated()
            # One that ended before the reset is seen here, one that ends after it wakes us below.
            for query in queries:
                if not query.isActive:
                    query.awaitTermination()
            if not any(query.isActive for query in queries):
                return
            try:
                spark.streams.awaitAnyTermination()
            except Exception:
                if all(query.exception() is None for query in queries):
                    continue  # a query of someone else
                raise
    except Exception:
        for query in queries:
            query.stop()
        raise
    finally:
        if watch is not None:
            spark.streams.removeListener(watch)
