"""Health of streams: every progress report of a query, in a table.

Spark itself keeps the last reports only. HealthTable listens, gathers reports on the
driver, and appends them to a table each `every` reports and when a query ends. A
batch that ran twice, before and after a restart, has two reports; read() gives the
later one.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

REPORT = (
    "id string, run string, batch long, at timestamp, rows long, rows_per_second double, processed_per_second double, milliseconds long, "
    "state_rows long, state_updated long, state_bytes long, dropped_late long, watermark string, newest string, lag_seconds double, observed string"
)


def _seconds(text: str | None) -> float | None:
    from datetime import datetime

    return datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() if text else None


def report_of(p) -> tuple:
    """The row of a progress report."""
    states, event = p.stateOperators, p.eventTime or {}
    mark, newest = event.get("watermark"), event.get("max")
    lag = _seconds(newest) - _seconds(mark) if mark and newest else None
    from datetime import datetime

    return (
        str(p.id), str(p.runId), p.batchId, datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")), p.numInputRows, float(p.inputRowsPerSecond), float(p.processedRowsPerSecond), (p.durationMs or {}).get("triggerExecution"),
        sum(s.numRowsTotal for s in states), sum(s.numRowsUpdated for s in states), sum(s.memoryUsedBytes for s in states), sum(s.numRowsDroppedByWatermark for s in states),
        mark, newest, lag, json.dumps({k: v.asDict() for k, v in p.observedMetrics.items()}) if p.observedMetrics else None,
    )


class HealthTable(StreamingQueryListener):
    """Use as a context around queries, or add() and close()."""

    def __init__(self, spark: SparkSession, folder: str, every: int = 50):
        self.spark, self.folder, self.every = spark, folder, every
        self.held: list[tuple] = []
        self.running: set[str] = set()
        self.lock = threading.Lock()
        self.seen = 0

    def __enter__(self) -> HealthTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.held.append(report_of(event.progress))
            self.seen += 1
            full = len(self.held) >= self.every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.running.discard(str(event.runId))
        self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
            if rows:
                self.spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(self.folder)

    def close(self, wait: float = 60) -> None:
        """Stop listening once the reports of queries that have ended are in; they come in order, so the end of a query is its last."""
        until = time.monotonic() + wait
        while self.running and time.monotonic() < until:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
        self.flush()

    def read(self) -> DataFrame:
        """A row for each batch of each query."""
        order = Window.partitionBy("id", "batch").orderBy(F.desc("at"))
        rows = self.spark.read.schema(REPORT).parquet(self.folder)
        return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
