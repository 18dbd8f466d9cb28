"""A row per micro-batch about a running stream: rows in and out, state, time, and counts observed on the way."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shelfline.session import stored

METRICS = (
    "query STRING, run_id STRING, batch BIGINT, started STRING, input_rows BIGINT, state_rows BIGINT, state_bytes BIGINT, "
    "duration_ms BIGINT, watermark STRING, observed MAP<STRING, STRING>"
)


def observed(df: DataFrame, name: str, *counts: Column) -> DataFrame:
    """`df` with aggregates that are taken as its rows pass, without another pass; they arrive with the batch's metrics."""
    return df.observe(name, *counts)


def type_counts(df: DataFrame, types: Sequence[str], column: str = "event_type", name: str = "types") -> DataFrame:
    """The number of rows of each type, observed."""
    return observed(df, name, *(F.count_if(F.col(column) == kind).alias(kind) for kind in types))


def metrics_row(progress) -> tuple:
    """What Spark reports of one micro-batch, in the order of METRICS."""
    state = progress.stateOperators
    seen = {f"{name}.{key}": str(value) for name, row in progress.observedMetrics.items() for key, value in row.asDict().items()}
    return (
        progress.name, str(progress.runId), progress.batchId, progress.timestamp, progress.numInputRows,
        sum(s.numRowsTotal for s in state), sum(s.memoryUsedBytes for s in state),
        progress.durationMs.get("triggerExecution", 0), progress.eventTime.get("watermark"), seen,
    )


class RunMetrics(StreamingQueryListener):
    """Collects a row per micro-batch of the streams of a session, and hands full batches of rows to `write` if it is given.

    Rows are a few numbers each, but a stream never ends: with `write` (for instance an append to a table) no more than `every` are held.
    """

    def __init__(self, write=None, every: int = 100):
        self._write, self._every = write, every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def _event(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append(metrics_row(event.progress))
            full, self._rows = (self._rows, []) if self._write and len(self._rows) >= self._every else ([], self._rows)
        if full:
            self._write(full)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self._write:
            with self._lock:
                rest, self._rows = self._rows, []
            if rest:
                self._write(rest)
        self._event(str(event.runId)).set()

    def rows(self, query: StreamingQuery, timeout: float = 60) -> list[tuple]:
        """The rows of a query that has ended; progress arrives a little after the batches themselves."""
        if not self._event(str(query.runId)).wait(timeout):
            raise TimeoutError("the end of the stream was not reported")
        with self._lock:
            return [r for r in self._rows if r[1] == str(query.runId)]


def table_writer(spark: SparkSession, folder: str):
    """A `write` for `RunMetrics` that appends to a folder of JSON lines, from Spark itself."""

    def write(rows: list[tuple]) -> None:
        spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").json(folder)

    return write


def metrics_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return stored(spark.createDataFrame(rows, METRICS))
