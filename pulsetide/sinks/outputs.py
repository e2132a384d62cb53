"""Where rows leave: archive, topics, JSON lines, routed lab files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from pulsetide.functions.parsing import text_id
from pulsetide.operators.quality import publishable, rejected_value, sent_value
from pulsetide.schemas import ARCHIVE, RAW_TEXT, READING

# Fixed value: time format of the JSON-lines output.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"


def archive_rows(readings: DataFrame) -> DataFrame:
    """Cleaned readings with their date partition and the time they were stored."""
    return readings.withColumns(
        {"ingested_at": F.current_timestamp(), "date": F.col("timestamp").cast("date")}
    ).select(*ARCHIVE.names)


def publish_rows(checked: DataFrame) -> DataFrame:
    """Valid readings as key, value and headers of a topic; the trace id is the event id."""
    trace = F.coalesce(F.col("event_id").cast("string"), F.uuid())
    return publishable(checked).select(
        F.col("patient_id").cast("string").alias("key"),
        F.to_json(F.struct(*READING.names)).alias("value"),
        _headers(trace),
    )


def dead_letter_rows(checked: DataFrame) -> DataFrame:
    """Rejected readings as key, value and headers of the dead-letter topic: the message as sent where it was kept, else all columns."""
    trace = F.coalesce(F.col("event_id").cast("string"), F.uuid())
    payload = [c for c in checked.columns if c not in ("invalid_detail", "arrival")]
    key = F.coalesce(F.expr(text_id("patient_id")), F.lit("unknown"))
    return checked.where(F.col("invalid_detail").isNotNull()).select(
        key.alias("key"), (sent_value() if RAW_TEXT in payload else rejected_value(payload)).alias("value"), _headers(trace)
    )


def _headers(trace):
    return F.array(F.struct(F.lit("trace_id").alias("key"), trace.cast("binary").alias("value"))).alias("headers")


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """Send key/value/headers rows of a batch. Needs Spark's Kafka connector on the class path."""
    (
        rows.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("includeHeaders", True)
        .save()
    )


def write_json_lines(windows: DataFrame, folder: str) -> None:
    """Windows sorted by patient and time, missing averages written as null."""
    (
        windows.orderBy("patient_id", "window_start")
        .write.mode("overwrite")
        .option("timestampFormat", ISO_SECONDS)
        .option("ignoreNullFields", False)
        .json(folder)
    )


def write_by_date(rows: DataFrame, folder: str, day: str = "date") -> None:
    """Replace the dates present in ``rows``, leave the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(folder)


def replace_day(reports: DataFrame, folder: str, report_date: date) -> None:
    """Make one report date hold exactly these rows, also when there are none."""
    day = reports.where(F.col("report_date") == F.lit(report_date)).drop("report_date")
    day.write.mode("overwrite").parquet(f"{folder}/report_date={report_date.isoformat()}")


def archive_labs(labs: DataFrame, folder: str) -> None:
    """Validated labs by collection date; a date that comes again is replaced."""
    write_by_date(labs.withColumn("date", F.col("collected_at").cast("date")), folder)
