"""Counts of every micro-batch, taken from the progress events of a stream.

Spark keeps only the last hundred progress reports of a query. The listener here stores each one when
it comes: one Parquet file per (query, batch), where ``query_id`` is the id that Spark keeps in the
checkpoint. A repeated batch replaces its own file, another checkpoint has another id, so several
streams can share a folder.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

OBSERVED = "counts"


def watched(stream: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """The stream with aggregates that ride along with each micro-batch; ``records`` is always among them."""
    named = [F.count(F.lit(1)).alias("records"), *[c.alias(n) for n, c in counts.items()]]
    return stream.observe(OBSERVED, *named)


class ProgressLog(StreamingQueryListener):
    """Writes the counts of every micro-batch of the session's streams, or of those named, to a folder."""

    def __init__(self, spark: SparkSession, path: str, counts: Mapping[str, Column], queries: set[str] | None = None):
        self.spark, self.path, self.queries = spark, path, queries
        self.names = ["records", *counts]
        self.schema = StructType([
            StructField("name", StringType()), StructField("run", StringType()), StructField("started_at", StringType()),
            StructField("input_rows", LongType()), *[StructField(n, LongType()) for n in self.names]])
        self.failures: list[str] = []
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        if self.queries is not None and seen.name not in self.queries:
            return
        found = seen.observedMetrics.get(OBSERVED)
        counts = [found[n] if found else 0 for n in self.names]
        row = (seen.name, str(seen.runId), seen.timestamp, seen.numInputRows, *counts)
        try:
            # Literals over one row: no Python worker takes part.
            columns = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, self.schema)]
            self.spark.range(0, 1, 1, 1).select(*columns).write.mode("overwrite").parquet(f"{self.path}/query_id={seen.id}/batch={seen.batchId}")
        except Exception as failure:  # noqa: BLE001 - an exception here would be swallowed by the event bus
            self.failures.append(f"batch {seen.batchId}: {failure}")

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def _event(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 600) -> None:
        """Until all events of an ended query are stored; a failed write is raised here."""
        query.awaitTermination()
        if not self._event(str(query.runId)).wait(seconds):
            raise TimeoutError(f"events of query {query.id} are still missing")
        if self.failures:
            raise RuntimeError("; ".join(self.failures))


def read_metrics(spark: SparkSession, log: ProgressLog) -> DataFrame:
    """(query_id, batch, name, run, started_at, input_rows, records, ...), a row for each micro-batch."""
    keys = [StructField("query_id", StringType()), StructField("batch", LongType())]
    return spark.read.schema(StructType(log.schema.fields + keys)).parquet(log.path)
