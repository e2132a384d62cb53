"""The speed layer: readings to live windows, alerts and archive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulsetide.operators.clean import clean_readings, dedupe_stream
from pulsetide.operators.quality import with_validity
from pulsetide.operators.windows import window_vitals
from pulsetide.params import WATERMARK, WINDOW_MINUTES, AlertLimits
from pulsetide.sinks.keyed_table import KeyedTable
from pulsetide.sinks.outputs import archive_rows
from pulsetide.streaming.reconcile import reconcile_alerts


def distinct_readings(raw: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    return dedupe_stream(clean_readings(raw), watermark)


def stream_windows(
    raw: DataFrame, minutes: int = WINDOW_MINUTES, limits: AlertLimits = AlertLimits(), watermark: str = WATERMARK
) -> DataFrame:
    return window_vitals(distinct_readings(raw, watermark), minutes, limits)


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_live(
    raw: DataFrame,
    live: KeyedTable,
    alerts: KeyedTable,
    checkpoint: str,
    available_now: bool = False,
    compact_every: int = 100,
    **options,
) -> StreamingQuery:
    """Upsert changed windows, then bring the alerts of their patients up to date.

    The batch id is the version: a batch that is retried replaces what it had
    written, and reads only what earlier batches wrote.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        live.write_changes(batch, batch_id)
        if live.changes(batch_id).isEmpty():
            return
        alerts.write_changes(reconcile_alerts(live, alerts, batch_id), batch_id)
        if batch_id and batch_id % compact_every == 0:
            for table in (live, alerts):
                table.compact(batch_id)
                table.vacuum()

    windows = stream_windows(raw, **options)
    return _start(windows.writeStream.foreachBatch(store).outputMode("update"), checkpoint, available_now)


def start_archive(
    raw: DataFrame,
    folder: str,
    checkpoint: str,
    available_now: bool = False,
    archive_late: bool = False,
    watermark: str = WATERMARK,
) -> StreamingQuery:
    """Append cleaned readings by date.

    With ``archive_late`` nothing is dropped behind the watermark; readers then
    remove copies with ``dedupe_readings``.
    """
    readings = clean_readings(raw) if archive_late else distinct_readings(raw, watermark)
    writer = archive_rows(readings).writeStream.format("parquet").option("path", folder).partitionBy("date")
    return _start(writer.outputMode("append"), checkpoint, available_now)


def start_intake(
    raw: DataFrame,
    accept: Callable[[DataFrame, int], None],
    reject: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Split a stream of readings into valid ones and dead letters in one pass over the source."""

    def route(batch: DataFrame, batch_id: int) -> None:
        checked = with_validity(batch).persist()
        try:
            accept(checked, batch_id)
            reject(checked, batch_id)
        finally:
            checked.unpersist()

    return _start(raw.writeStream.foreachBatch(route), checkpoint, available_now)


def run_until_any_ends(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for the first query to end, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
