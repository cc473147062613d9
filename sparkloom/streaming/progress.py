"""Progress of streaming queries as a table, and queries that stop when nothing more comes."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from sparkloom.streaming.runner import prepared

IDLE = "300ms"  # without new data for so long, a query counts as idle
PROGRESS = "batch_id long, input_rows long, milliseconds long, started string"


class BatchLog(StreamingQueryListener):
    """Rows and time of each batch of one query, and whether it has been idle since its last batch.

    Holds four numbers a batch until `take` hands them over.
    """

    def __init__(self):
        self.query_id: str | None = None
        self.idle, self.ended = threading.Event(), threading.Event()
        self._batches: dict[int, tuple] = {}
        self._lock = threading.Lock()

    def _mine(self, event) -> bool:
        return self.query_id is not None and str(event.id) == self.query_id

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.query_id is not None and str(progress.id) == self.query_id:
            with self._lock:
                self._batches[progress.batchId] = (progress.batchId, progress.numInputRows,
                                                   progress.durationMs.get("triggerExecution", 0), progress.timestamp)
            self.idle.clear()

    def onQueryIdle(self, event) -> None:
        if self._mine(event):
            self.idle.set()

    def onQueryTerminated(self, event) -> None:
        if self._mine(event):
            self.ended.set()

    def take(self) -> list[tuple]:
        with self._lock:
            out, self._batches = sorted(self._batches.values()), {}
        return out


def run_until_idle(spark: SparkSession, writer: DataStreamWriter, checkpoint: str, every: str,
                   timeout: float = 600) -> DataFrame:
    """Run a query at an interval until a trigger finds nothing new, then stop it; one row for each batch.

    A failed query raises. After `timeout` seconds the query is stopped as it is; the next run goes on from the
    checkpoint.
    """
    log, limit, pause = BatchLog(), time.monotonic() + timeout, "spark.sql.streaming.noDataProgressEventInterval"
    spark.streams.addListener(log)
    usual = spark.conf.get(pause)
    try:
        spark.conf.set(pause, IDLE)  # a query takes the setting with it when it starts
        query = prepared(writer, checkpoint, every).start()
        log.query_id = str(query.id)
        try:
            # Events of batches that ended before the identifier was known are in the query's own recent progress.
            while not log.idle.wait(0.2) and query.isActive and time.monotonic() < limit:
                pass
            if query.exception() is not None:
                raise query.exception()
            early = [(p["batchId"], p["numInputRows"], p["durationMs"].get("triggerExecution", 0), p["timestamp"])
                     for p in query.recentProgress if p["numInputRows"]]
        finally:
            query.stop()
        log.ended.wait(10)
    finally:
        spark.conf.set(pause, usual)
        spark.streams.removeListener(log)
    batches = {row[0]: row for row in [*early, *[row for row in log.take() if row[1]]]}
    return spark.createDataFrame([batches[number] for number in sorted(batches)], PROGRESS)
