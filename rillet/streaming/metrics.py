"""Figures of every batch of running streams, in a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "run string, batch bigint, stage string, rows bigint"
#: Stage name of the rows that a watermark dropped.
LATE = "dropped_late"


class StageMetrics(StreamingQueryListener):
    """Appends, as each batch ends, the rows of its observed stages and those dropped as
    late; a query's own list of progress holds its last batches only. As a context manager
    it listens while the context is open."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path
        self.started, self.ended, self.changed = 0, 0, threading.Condition()

    def __enter__(self) -> StageMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.started += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [(str(p.runId), p.batchId, stage, int(values["rows"] or 0))
                for stage, values in p.observedMetrics.items()]
        rows.append((str(p.runId), p.batchId, LATE,
                     sum(op.numRowsDroppedByWatermark for op in p.stateOperators)))
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended += 1
            self.changed.notify_all()

    def settle(self, timeout: float = 120) -> None:
        """Wait until the queries started so far have ended and their batches are stored:
        events of a query come in order, its end last."""
        with self.changed:
            if not self.changed.wait_for(lambda: self.ended >= self.started, timeout):
                raise TimeoutError(f"{self.ended} of {self.started} queries have ended")

    def read(self) -> DataFrame:
        """(run, batch, stage, rows); a batch that was run again counts once."""
        return self.spark.read.schema(SCHEMA).parquet(self.path).dropDuplicates(["run", "batch", "stage"])
