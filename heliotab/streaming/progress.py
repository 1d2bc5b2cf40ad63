"""What streaming queries did: started, rows of each batch, ended or failed."""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

EVENT = "query string, id string, run_id string, event string, batch long, rows long, millis long, error string"
MOST_EVENTS = 10_000


class ProgressLog(StreamingQueryListener):
    """Keeps the latest events of all queries of a session.

    ``event`` is ``started``, ``batch`` (with its number, input rows and duration), ``ended`` or
    ``failed`` (with the first line of the error).  Only the latest ``most`` events are held.
    """

    def __init__(self, most: int = MOST_EVENTS):
        self.events: deque[tuple] = deque(maxlen=most)
        self._names: dict[str, str | None] = {}
        self._changed = threading.Condition()

    def _add(self, run_id, query_id, event, batch=None, rows=None, millis=None, error=None) -> None:
        with self._changed:
            name = self._names.get(str(run_id))
            self.events.append((name, str(query_id), str(run_id), event, batch, rows, millis, error))
            self._changed.notify_all()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name
        self._add(event.runId, event.id, "started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add(p.runId, p.id, "batch", p.batchId, p.numInputRows, p.batchDuration)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        error = (event.exception or "").strip().split("\n")[0] or None
        self._add(event.runId, event.id, "failed" if event.exception else "ended", error=error)
        self._names.pop(str(event.runId), None)

    def wait(self, run_ids: list[str], timeout: float = 60.0) -> bool:
        """Wait until the end of all these runs has been told; events arrive a little after it."""

        def told() -> bool:
            over = {e[2] for e in self.events if e[3] in ("ended", "failed")}
            return over >= set(map(str, run_ids))

        with self._changed:
            return self._changed.wait_for(told, timeout)

    def table(self, spark: SparkSession) -> DataFrame:
        with self._changed:
            return spark.createDataFrame(list(self.events), EVENT)


@contextmanager
def recorded(spark: SparkSession, most: int = MOST_EVENTS) -> Iterator[ProgressLog]:
    """Record all queries of the session while the block runs."""
    log = ProgressLog(most)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
