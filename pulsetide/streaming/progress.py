"""How a streaming query is doing, as rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "name string, batch_id long, input_rows long, rows_per_second double, "
    "watermark string, state_rows long, state_memory_bytes long, dropped_late long"
)


def _row(p: dict) -> tuple:
    states = p.get("stateOperators") or []
    return (
        p.get("name"),
        p["batchId"],
        p["numInputRows"],
        float(p.get("processedRowsPerSecond") or 0.0),
        (p.get("eventTime") or {}).get("watermark"),
        sum(s["numRowsTotal"] for s in states),
        sum(s["memoryUsedBytes"] for s in states),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
    )


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch. Spark keeps a bounded number of them: totals come from ``ProgressLog``."""
    reports = [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]
    return spark.createDataFrame([_row(p) for p in reports], SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Stores every micro-batch of the session's streams as a row, however long they run.

    Each is a small file of its own, named by run and batch, so that a report
    that comes twice counts once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        row = self.spark.createDataFrame([_row(p)], SCHEMA).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.folder}/run={p['runId']}/batch={p['batchId']}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(self.folder)
