"""Progress of streaming queries as a metrics frame."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

METRICS = (
    "query STRING, batch_id BIGINT, input_rows BIGINT, input_rows_per_second DOUBLE, "
    "processed_rows_per_second DOUBLE, batch_ms BIGINT, state_rows BIGINT"
)


def _row(progress) -> tuple:
    p = json.loads(progress.json) if hasattr(progress, "json") else dict(progress)
    return (
        p.get("name"),
        p["batchId"],
        p["numInputRows"],
        p.get("inputRowsPerSecond"),
        p.get("processedRowsPerSecond"),
        p.get("batchDuration"),
        sum(s["numRowsTotal"] for s in p.get("stateOperators", [])),
    )


def progress_frame(spark: SparkSession, query) -> DataFrame:
    """Metrics of the query's recent micro-batches. Spark keeps the newest hundred; ProgressLog keeps all."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], METRICS)


def append_progress(spark: SparkSession, query, path: str) -> None:
    """Add the metrics of a query that has ended to a folder; for a query of few micro-batches."""
    progress_frame(spark, query).write.mode("append").parquet(path)


class ProgressLog(StreamingQueryListener):
    """Appends the metrics of every micro-batch of a session's queries to a folder of JSON files, one per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.spark.createDataFrame([_row(event.progress)], METRICS).coalesce(1).write.mode("append").json(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def frame(self) -> DataFrame:
        return self.spark.read.schema(METRICS).json(self.path)
