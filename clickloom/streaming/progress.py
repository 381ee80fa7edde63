"""Progress of streaming queries as a table: rows read and rejected, rows in state, rows too late."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("batch_at", T.StringType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("accepted", T.LongType()),
    T.StructField("rejected", T.LongType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("dropped_late", T.LongType()),
])


class ProgressLog(StreamingQueryListener):
    """Collects one small row per micro-batch; `flush`, called by the job and not in the callback, appends them to a
    parquet table.

    Events reach a listener some time after their micro-batch, perhaps after the query has ended. `complete` adds what a query itself
    still knows, so that the last micro-batches of a job are not lost.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []
        self._last: dict[str, int] = {}  # the newest micro-batch noted of each run; those of a run come in order
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._note(event.progress)

    def _note(self, p) -> None:
        seen = p.observedMetrics.get("rows") if p.observedMetrics else None
        row = (
            p.name, p.batchId, p.timestamp, p.numInputRows,
            seen["accepted"] if seen else None, seen["rejected"] if seen else None,
            sum(s.numRowsTotal for s in p.stateOperators),
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        )
        with self._lock:
            if p.batchId > self._last.get(str(p.runId), -1):
                self._last[str(p.runId)] = p.batchId
                self._rows.append(row)

    def complete(self, query: StreamingQuery) -> None:
        """Note the micro-batches of a query that has ended and that no event has told of yet."""
        for progress in query.recentProgress:
            self._note(progress)

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)
