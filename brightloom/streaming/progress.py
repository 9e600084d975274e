"""What streams did: triggers, batches and failures as a table."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent,
                                            StreamingQueryListener)

EVENTS = """query string, name string, event string, batch_id long, at timestamp, input_rows long, dropped_rows long,
            state_rows long, milliseconds long, error string"""


class ProgressLog(StreamingQueryListener):
    """Records every event of the queries of a session, one row each: ``started``,
    ``progress`` per batch (rows read, rows that came after the watermark, rows of state,
    duration) and ``ended``, with the error if it failed. Use as a context manager."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _add(self, *row) -> None:
        with self._lock:
            self._rows.append(row)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._add(str(event.id), event.name, "started", None, _time(event.timestamp), None, None, None, None, None)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        self._add(str(p.id), p.name, "progress", p.batchId, _time(p.timestamp), p.numInputRows,
                  sum(s.numRowsDroppedByWatermark for s in p.stateOperators), sum(s.numRowsTotal for s in p.stateOperators),
                  p.durationMs.get("triggerExecution"), None)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._add(str(event.id), None, "ended", None, None, None, None, None, None, event.exception)

    def settle(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Wait until the end of a query has been recorded; events come a little later."""
        until = time.monotonic() + seconds
        while not any(r[0] == str(query.id) and r[2] == "ended" for r in list(self._rows)) and time.monotonic() < until:
            time.sleep(0.05)

    def table(self) -> DataFrame:
        with self._lock:
            return self.spark.createDataFrame(list(self._rows), EVENTS)


def _time(text: str):
    from datetime import datetime

    return datetime.fromisoformat(text)
