"""Landing folder of lab files: validate each whole file and route it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulsetide.operators.labs import accepted_rows
from pulsetide.session import store
from pulsetide.sources.lab_files import (
    empty_files,
    headers,
    in_file_order,
    inventory,
    lab_file_verdicts,
    lab_rows,
    stream_lab_text,
)


def start_lab_intake(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    strict: bool = False,
    available_now: bool = False,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Rows of accepted files to ``processed``, every file's verdict to ``verdicts``.

    A micro-batch always holds whole files, so a file is judged once. Outputs
    are folders per batch, replaced when a batch is retried.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        lines = in_file_order(batch).persist()
        try:
            heads = store(headers(lines), f"{target}/headers/batch={batch_id}")
            rows = lab_rows(lines, heads)
            verdicts = store(lab_file_verdicts(rows, heads, strict), f"{target}/verdicts/batch={batch_id}")
            accepted = accepted_rows(rows.where("NOT header_line").drop("header_line"), verdicts)
            accepted.write.mode("overwrite").parquet(f"{target}/processed/batch={batch_id}")
        finally:
            lines.unpersist()

    writer = stream_lab_text(spark, landing, files_per_trigger).writeStream.foreachBatch(route)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def intake_verdicts(spark: SparkSession, landing: str, target: str) -> DataFrame:
    """Verdicts of all files seen so far; a landed file, at any depth, of which no batch saw a line is empty."""
    seen = spark.read.parquet(f"{target}/verdicts").drop("batch")
    return seen.unionByName(empty_files(inventory(spark, landing), seen))
