"""Per-query performance metrics from streaming progress (W7).

``PerformanceLog`` listens to the session's streams and appends one row for each
micro-batch to a table, so the metrics survive the process and no batch is lost
to Spark's short list of recent progress (100 records by default)."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tierflow.sinks.tables import TableStore

PROGRESS_SCHEMA = ("query string, run_id string, batch_id long, input_rows long, "
                   "duration_ms long, input_rows_per_second double, timestamp string")
PERFORMANCE_TABLE = "_performance_metrics"
FLUSH_ROWS = 10_000  # micro-batches held by the driver at most, before they are written
PATIENCE_SECONDS = 60


def _row(p, name: str | None) -> tuple:
    return (name or str(p.id), str(p.runId), int(p.batchId), int(p.numInputRows or 0),
            int((p.durationMs or {}).get("triggerExecution", 0)), float(p.inputRowsPerSecond or 0.0), str(p.timestamp))


def progress_rows(query) -> list[tuple]:
    """One tuple per micro-batch of a finished or running query.  Spark keeps
    a bounded number of progress records (spark.sql.streaming.numRecentProgressUpdates)."""
    return [_row(p, query.name) for p in query.recentProgress]


def progress_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, PROGRESS_SCHEMA).withColumn("timestamp", F.to_timestamp("timestamp"))


class PerformanceLog(StreamingQueryListener):
    """Context manager: while it is open, every micro-batch of the watched queries is
    logged; on leaving it waits for the last event of each, then writes the rest."""

    def __init__(self, spark: SparkSession, store: TableStore, table: str = PERFORMANCE_TABLE):
        self.spark, self.store, self.table = spark, store, table
        self._lock, self._ended = threading.Condition(), set()
        self._rows: list[tuple] = []
        self._watched: set[str] = set()

    def watch(self, query: StreamingQuery | None) -> StreamingQuery | None:
        if query is not None:
            with self._lock:
                self._watched.add(str(query.runId))
        return query

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append(_row(event.progress, event.progress.name))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:  # comes after the query's last progress
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def flush(self, least: int = 1) -> int:
        """Append the rows so far as one batch of the table, if there are ``least``;
        those of queries that are not watched are other owners' and left out."""
        with self._lock:
            mine = [r for r in self._rows if r[1] in self._watched]
            if len(mine) < least:
                return 0
            self._rows = [r for r in self._rows if r[1] not in self._watched]
            have = self.store.batches(self.table)
            self.store.append_batch(self.table, progress_frame(self.spark, mine).withColumnRenamed(
                "batch_id", "micro_batch").coalesce(1), have[-1] + 1 if have else 0)
            return len(mine)

    def wait(self, query: StreamingQuery) -> None:
        """Until the query ends; long runs are written as they go."""
        while not query.awaitTermination(5):
            self.flush(FLUSH_ROWS)

    def __enter__(self) -> PerformanceLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        until = time.monotonic() + PATIENCE_SECONDS
        with self._lock:
            while not self._watched <= self._ended and time.monotonic() < until:
                self._lock.wait(0.2)
        self.spark.streams.removeListener(self)
        self.flush()


def performance(store: TableStore, table: str = PERFORMANCE_TABLE) -> DataFrame:
    """Per query: micro-batches with rows, rows and time, over all runs."""
    real = F.col("input_rows") > 0
    return store.read(table).groupBy("query").agg(
        F.count_if(real).alias("batches"), F.sum("input_rows").alias("rows"), F.sum("duration_ms").alias("duration_ms"),
        F.max("timestamp").alias("last_batch_at"))
