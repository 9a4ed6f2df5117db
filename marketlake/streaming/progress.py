"""Progress of streams as a table, and a clean end by a marker.

A listener notes every micro-batch as it finishes; notes are written from the thread
that runs the stream, so the listener itself never starts a job.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from marketlake.session import delete_path, path_exists

PROGRESS_SCHEMA = (
    "run_id string, name string, batch_id long, triggered_at string, rows long, duration_ms long, state_rows long, "
    "state_bytes long, dropped_rows long, watermark string")


def _note(progress) -> tuple:
    """A row of the progress table from a progress report."""
    operators = progress["stateOperators"] or []
    return (
        str(progress["runId"]), progress["name"], int(progress["batchId"]), str(progress["timestamp"]),
        int(progress["numInputRows"]), int((progress["durationMs"] or {}).get("triggerExecution", 0)),
        sum(int(o["numRowsTotal"]) for o in operators), sum(int(o["memoryUsedBytes"]) for o in operators),
        sum(int(o["numRowsDroppedByWatermark"]) for o in operators), (progress["eventTime"] or {}).get("watermark"),
    )


class ProgressRecorder(StreamingQueryListener):
    """Notes the progress of the session's streams and writes it to the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._lock = threading.Lock()
        self._held: dict[tuple[str, int], tuple] = {}
        self._written: dict[str, int] = {}

    def _hold(self, note: tuple) -> None:
        run, batch = note[0], note[2]
        with self._lock:
            if batch > self._written.get(run, -1):
                self._held[run, batch] = note

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._hold(_note(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self, query: StreamingQuery | None = None) -> int:
        """Append what was noted since the last call; returns the number of batches.
        Reports of ``query`` that the listener has not been given yet are taken from it."""
        for progress in query.recentProgress if query is not None else []:
            self._hold(_note(progress))
        with self._lock:
            notes, self._held = sorted(self._held.values(), key=lambda n: (n[0], n[2])), {}
            for note in notes:
                self._written[note[0]] = max(note[2], self._written.get(note[0], -1))
        if notes:
            self.spark.createDataFrame(notes, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return len(notes)


def run_until_stopped(
    spark: SparkSession, start, progress_path: str, stop_marker: str | None = None, every_seconds: float = 30.0
) -> StreamingQuery:
    """Start a stream (``start()`` returns the query) and stay with it until it ends or
    ``stop_marker`` appears. The stream is then stopped between two micro-batches, so no
    batch is cut off, and the marker is removed. Progress is written as it goes."""
    recorder = ProgressRecorder(spark, progress_path)
    spark.streams.addListener(recorder)
    try:
        query = start()
        while not query.awaitTermination(every_seconds):
            recorder.flush(query)
            if stop_marker and path_exists(spark, stop_marker):
                while query.isActive and query.status["isTriggerActive"]:
                    query.awaitTermination(0.1)
                query.stop()
                delete_path(spark, stop_marker)
        recorder.flush(query)
        return query
    finally:
        spark.streams.removeListener(recorder)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per run and micro-batch, whatever was noted twice."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path).dropDuplicates(["run_id", "batch_id"])


def batch_totals(progress: DataFrame) -> DataFrame:
    """Rows and longest state by batch, over all runs of a stream."""
    return progress.groupBy("batch_id").agg(
        F.sum("rows").alias("rows"), F.max("state_rows").alias("state_rows"), F.sum("dropped_rows").alias("dropped_rows"))
