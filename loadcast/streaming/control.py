"""Progress of a stream as rows, and a stop between batches.

``BatchGate`` wraps the function that writes a batch: once a stop is asked for, a
batch that is being written is finished, and none begins.  A batch that was
planned but not begun is not committed, so a restart runs it whole.
``ProgressRows`` is a listener that keeps one row per batch as Spark reports it.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

_STOPPED = "stopped between batches"


class BatchGate:
    def __init__(self):
        self._lock, self._stopping, self._writing = threading.Lock(), False, False

    def wrap(self, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """``write`` for foreachBatch; raises before it begins if a stop was asked for."""

        def gated(batch: DataFrame, batch_id: int) -> None:
            with self._lock:
                if self._stopping:
                    raise RuntimeError(_STOPPED)
                self._writing = True
            try:
                write(batch, batch_id)
            finally:
                with self._lock:
                    self._writing = False

        return gated

    def stop(self, query: StreamingQuery, poll_s: float = 0.05) -> None:
        """Stop the stream when no batch is being written."""
        with self._lock:
            self._stopping = True
        while query.isActive:
            with self._lock:
                idle = not self._writing
            if idle:
                query.stop()  # a batch that begins now raises before it writes
                break
            time.sleep(poll_s)
        error = query.exception()
        if error is not None and _STOPPED not in str(error):
            raise error


class ProgressRows(StreamingQueryListener):
    """Rows (batch_id, input_rows, duration_ms, state_rows, late_rows) of one stream, batches without input included."""

    SCHEMA = "batch_id long, input_rows long, duration_ms long, state_rows long, late_rows long"

    def __init__(self, name: str):
        self.name, self.rows, self._id, self._done = name, {}, None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._id = event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.name:
            state = p.stateOperators
            self.rows[p.batchId] = (
                p.batchId, p.numInputRows, int(p.batchDuration), sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state)
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self._id:
            self._done.set()

    def frame(self, spark: SparkSession, wait_s: float = 60) -> DataFrame:
        """The rows, once the stream has ended (its last event comes after all progress)."""
        if not self._done.wait(wait_s):
            raise TimeoutError(f"stream {self.name} has not ended")
        return spark.createDataFrame([self.rows[b] for b in sorted(self.rows)], self.SCHEMA)
