"""Progress of streams as a table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillmark.sinks.keyindex import _write_text
from tillmark.sinks.lake import path_exists

PROGRESS = "query string, run string, batch bigint, at timestamp, input_rows bigint, rows_per_second double, metric string, value bigint"


class ProgressLog(StreamingQueryListener):
    """Write every progress of the session's streams under ``path``, one small file per query, run and batch.

    Spark itself keeps only the last hundred in memory.  Register it with ``spark.streams.addListener`` before the
    streams start.  A batch that is repeated in a new run is logged again; `counters` counts it once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        lines = [json.dumps({
            "query": progress.name or str(progress.id), "run": str(progress.runId), "batch": progress.batchId, "at": progress.timestamp,
            "input_rows": progress.numInputRows, "rows_per_second": progress.processedRowsPerSecond, "metric": metric, "value": value})
            for row in progress.observedMetrics.values() for metric, value in row.asDict().items()]
        if lines:
            _write_text(self.spark, f"{self.path}/{progress.id}-{progress.runId}-{progress.batchId}.json", "\n".join(lines) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def finished(query: StreamingQuery) -> None:
    """Wait until the stream has ended and its last progress has been told to the listeners."""
    query.awaitTermination()
    query._jsq.sparkSession().sparkContext().listenerBus().waitUntilEmpty()


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per query, run, batch and observed metric."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(path)


def counters(spark: SparkSession, path: str) -> DataFrame:
    """Sum of every observed metric per query over all batches; of a repeated batch the last run counts."""
    last = progress_rows(spark, path).groupBy("query", "metric", "batch").agg(F.max_by("value", "at").alias("value"))
    return last.groupBy("query", "metric").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("batches"))
