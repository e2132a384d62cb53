"""Alerts from closed windows with keyed state, for streams in append mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from pulsetide.operators.episodes import alert_id
from pulsetide.operators.upsert import latest_by_key
from pulsetide.schemas import EPISODE
from pulsetide.session import use_rocksdb_state

CHANGE = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("triggered_at", T.TimestampType()),
        T.StructField("resolved_at", T.TimestampType()),
    ]
)


def _processor():
    # Local classes travel to the workers by value: executors need no copy of this package.
    from datetime import datetime, timezone

    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

    kind = T.StructType([T.StructField("alert_type", T.StringType())])
    since = T.StructType([T.StructField("triggered_at", T.TimestampType())])

    change = Row(*CHANGE.names)
    instant = T.TimestampType()

    class OpenAlerts(StatefulProcessor):
        """State: open alert types of a patient, with the time each opened."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.open = handle.getMapState("open", kind, since)

        def handleInputRows(self, key, rows, timerValues):
            patient = key[0]
            # One read and, at the end, only what changed: each state call crosses to the JVM.
            before = {k[0]: instant.toInternal(v[0]) for k, v in self.open.iterator()}
            opened = dict(before)
            for row in sorted(rows, key=lambda r: r.window_start):
                flags = set(row.anomaly_flags.split(",")) if row.anomaly_flags else set()
                for name in sorted(flags - opened.keys()):
                    opened[name] = row.window_start
                    yield change(patient, name, row.window_start, None)
                for name in sorted(opened.keys() - flags):
                    yield change(patient, name, opened.pop(name), row.window_end)
            for name in before.keys() - opened.keys():
                self.open.removeKey((name,))
            for name, time in opened.items():
                if before.get(name) != time:
                    self.open.updateValue((name,), (datetime.fromtimestamp(time // 1_000_000, timezone.utc).replace(microsecond=time % 1_000_000),))

        def handleInitialState(self, key, initialState, timerValues):
            for alert in initialState.alerts:
                self.open.updateValue((alert["alert_type"],), (alert["triggered_at"],))

        def close(self) -> None:
            pass

    return OpenAlerts()


def alert_changes(closed_windows: DataFrame, open_alerts: DataFrame | None = None) -> DataFrame:
    """Openings (no end yet) and closings of alerts, from a stream of final windows.

    ``open_alerts`` (episodes without an end) are the state that a new checkpoint starts
    with: the stream closes them, and does not open them again.

    State is at most four entries per patient. A patient's windows come in
    time order across batches, because a window is final only once the
    watermark has passed it; within a batch they are few and sorted here.
    """
    use_rocksdb_state(closed_windows.sparkSession)
    # Times as numbers and flags as one text: a cell that Python has to make a date or a list of costs several times as much.
    times = {c: F.unix_micros(c).alias(c) for c in ("window_start", "window_end")}
    flags = F.array_join("anomaly_flags", ",").alias("anomaly_flags")
    made = T.StructType([T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in CHANGE])
    held = None
    if open_alerts is not None:
        # At most one alert of a type is open: one small row per patient.
        alerts = F.collect_list(F.struct("alert_type", "triggered_at")).alias("alerts")
        rows = open_alerts.where("resolved_at IS NULL").groupBy("patient_id").agg(alerts)
        held = rows.groupBy("patient_id")
    return (
        closed_windows.select("patient_id", *times.values(), flags)
        .groupBy("patient_id")
        .transformWithState(_processor(), made, "Append", "none", initialState=held)
        .select(*[F.timestamp_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name for f in CHANGE])
    )


def episodes_from_changes(changes: DataFrame) -> DataFrame:
    """Current episodes: a closing replaces its opening."""
    latest = latest_by_key(
        changes.withColumn("closed", F.col("resolved_at").isNotNull()),
        ["patient_id", "alert_type", "triggered_at"],
        "closed",
    )
    identity = alert_id(F.col("patient_id"), F.col("alert_type"), F.col("triggered_at"))
    return latest.withColumn("alert_id", identity).select(*EPISODE.names)
