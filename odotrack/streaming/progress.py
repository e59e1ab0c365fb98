"""What streams report while they run, kept as a table: input, late rows, gate counts."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, run string, batch long, input_rows long, late_rows long, gate string, measure string, value long"


class ProgressLog(StreamingQueryListener):
    """Rows of every batch of the streams started while it listens: one for the batch
    (``gate`` NULL), one for each number a gate's observation counted in it.

    ``late_rows`` are those that stateful operators dropped behind their watermark; an
    operator that aggregates before it looks at the watermark counts partial groups."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self._running: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        batch = (progress.name, str(progress.runId), progress.batchId, progress.numInputRows, late)
        rows = [(*batch, None, None, None)]
        for gate, counts in progress.observedMetrics.items():
            rows += [(*batch, gate, name, value) for name, value in counts.asDict().items()]
        with self._changed:
            self.rows += rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._running.discard(str(event.runId))
            self._changed.notify_all()

    def wait(self, seconds: float = 60.0) -> None:
        """Until every stream that ended has said so: reports arrive behind their batches,
        and the end behind the last of them."""
        with self._changed:
            self._changed.wait_for(lambda: not self._running, seconds)


@contextmanager
def progress_log(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """Append what streams report inside the block to the table at ``path``. Streams started
    there should have ended when it is left."""
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        log.wait()
        spark.streams.removeListener(log)
        if log.rows:
            spark.createDataFrame(log.rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
