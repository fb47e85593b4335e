"""What a running job has read and committed."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from flowlake.sinks.tables import read_table

PROGRESS = """
    query STRING, run_id STRING, batch_id BIGINT, rows_read BIGINT, rows_per_second DOUBLE,
    rows_late BIGINT, polled_at STRING
"""


def progress_row(event) -> tuple:
    """One row of a query's progress report."""
    late = sum(state["numRowsDroppedByWatermark"] for state in event.get("stateOperators") or [])
    return (
        event["name"],
        str(event["runId"]),
        int(event["batchId"]),
        int(event["numInputRows"]),
        float(event.get("processedRowsPerSecond") or 0.0),
        int(late),
        event["timestamp"],
    )


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent batches of a query: rows read, batch committed, time of the poll.

    Spark keeps the last 100 reports of a query only; ``ProgressLog`` has all of them.
    """
    reports = [progress_row(report) for report in query.recentProgress]
    return spark.createDataFrame(reports, PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Append every progress report of the session to a table.

    Reports are written in groups: when ``group`` of them wait, when the oldest has waited for
    ``seconds`` as the next one comes, and when a query ends.
    """

    def __init__(self, spark: SparkSession, path: str, group: int = 200, seconds: float = 30.0):
        self.spark = spark
        self.path = path
        self.group = group
        self.seconds = seconds
        self._waiting: list[tuple] = []
        self._since = time.monotonic()
        self._ended: set[str] = set()
        self._state = threading.Condition()
        self._writing = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = progress_row(json.loads(event.progress.json))
        with self._state:
            if not self._waiting:
                self._since = time.monotonic()
            self._waiting.append(row)
            due = len(self._waiting) >= self.group or time.monotonic() - self._since >= self.seconds
        if due:
            self.flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.flush()
        with self._state:
            self._ended.add(str(event.runId))
            self._state.notify_all()

    def flush(self) -> None:
        """Write what waits. Reports that cannot be written wait on."""
        with self._writing:
            with self._state:
                rows = list(self._waiting)
            if not rows:
                return
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            with self._state:
                del self._waiting[: len(rows)]

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Until all reports of a query that has ended are written."""
        with self._state:
            if not self._state.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError("the end of the query was not reported")

    def read(self) -> DataFrame:
        """All reports so far."""
        self.flush()
        return read_table(self.spark, self.path, PROGRESS)
