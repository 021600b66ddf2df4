"""Progress of running queries as plain rows."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = "id string, name string, batch_id long, input_rows long, input_rows_per_second double"


class ProgressLog(StreamingQueryListener):
    """Progress reports of all queries; register with `spark.streams.addListener`.

    With `path` every report is kept: after each `keep` reports they go to a file there, one row per
    query and batch, and `flush` writes the rest; `history` reads them. Without a path the newest
    `keep` reports stay in memory.
    """

    def __init__(self, keep: int = 1000, spark: SparkSession | None = None, path: str | None = None):
        if path and not spark:
            raise ValueError("a path needs a session")
        self.keep, self.spark, self.path = keep, spark, path
        self.rows: list[dict] = []
        self.ended: set[str] = set()
        self._lock = threading.Lock()

    def add(self, row: dict) -> None:
        with self._lock:
            self.rows.append(row)
            full = len(self.rows) >= self.keep if self.path else False
            if not self.path:
                del self.rows[: -self.keep]
        if full:
            self.flush()

    def flush(self) -> None:
        """Write the reports in memory; what cannot be written stays there."""
        if not self.path:
            return
        with self._lock:
            rows, self.rows = self.rows, []
        if not rows:
            return
        try:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
        except Exception:
            with self._lock:
                self.rows = rows + self.rows
            raise

    def onQueryStarted(self, event):
        self.ended.discard(str(event.id))

    def onQueryProgress(self, event):
        p = event.progress
        self.add(
            {
                "id": str(p.id),
                "name": p.name,
                "batch_id": p.batchId,
                "input_rows": p.numInputRows,
                "input_rows_per_second": p.inputRowsPerSecond,
            }
        )

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.id))


def history(spark: SparkSession, path: str) -> DataFrame:
    """All written reports, one per query and batch: a batch that ran again after a restart is
    reported by the run that read most."""
    last = F.max_by(F.struct("name", "input_rows", "input_rows_per_second"), F.struct("input_rows", "input_rows_per_second"))
    rows = spark.read.schema(PROGRESS).parquet(path).groupBy("id", "batch_id").agg(last.alias("r"))
    return rows.select("id", "r.name", "batch_id", "r.input_rows", "r.input_rows_per_second")


def report(queries: list[StreamingQuery]) -> list[dict]:
    """One row per query: name, whether it runs, input rate and last batch."""
    rows = []
    for q in queries:
        last = q.lastProgress
        rows.append(
            {
                "name": q.name,
                "active": q.isActive,
                "input_rows_per_second": last["inputRowsPerSecond"] if last else None,
                "batch_id": last["batchId"] if last else None,
            }
        )
    return rows


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every active query; names of those stopped."""
    names = []
    for q in spark.streams.active:
        q.stop()
        names.append(q.name)
    return names
