"""Progress of streaming queries, kept beyond the last hundred micro-batches a query remembers."""

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from docflow.sources import folders

PROGRESS = "query_id string, run_id string, name string, batch_id long, at string, input_rows long, rows_per_second double, duration_ms long"


def report(progress) -> dict:
    """Batch number, rows (of a topic: messages) in, rows per second and time of a micro-batch."""
    return {
        "batch_id": progress.batchId,
        "input_rows": progress.observedMetrics["topic"].rows if "topic" in progress.observedMetrics else progress.numInputRows,
        "rows_per_second": progress.processedRowsPerSecond,
        "duration_ms": progress.batchDuration,
    }


class ProgressLog(StreamingQueryListener):
    """Writes the progress of each micro-batch of all queries of a session to a folder, a small file each.

    A micro-batch that runs again in another run of its query has a file for each run. Events come on a thread of their own, after the
    micro-batch; `wait` returns once those of an ended query are written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "at": p.timestamp, **report(p)}
        folders.write_text(self.spark, f"{self.path}/{p.runId}-{p.batchId}.json", json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Whether all progress of a query that has ended is written; False if that takes longer."""
        with self.changed:
            return self.changed.wait_for(lambda: str(query.runId) in self.ended, seconds)


def kept_progress(spark: SparkSession, path: str) -> DataFrame:
    """The micro-batches in the folder of a `ProgressLog`; none before the first."""
    if not folders.exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(path)
