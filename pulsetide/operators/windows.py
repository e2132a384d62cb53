"""Tumbling windows of readings per patient."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsetide.functions.flags import flag_array, reading_checks
from pulsetide.params import SHORT_NAMES, WINDOW_MINUTES, AlertLimits
from pulsetide.schemas import WINDOW


def window_vitals(
    readings: DataFrame, minutes: int = WINDOW_MINUTES, limits: AlertLimits = AlertLimits()
) -> DataFrame:
    """Averages, extremes, count and flags per patient and window.

    Works on a batch and on a watermarked stream. All aggregates combine on the
    map side in fixed-width buffers: a patient with a third of all readings
    reaches the shuffle as one row per window and task. Widths that divide 60
    start on the hour; others are aligned to the epoch.
    """
    trips = reading_checks(limits)
    aggregates = [f"avg({name}) AS avg_{short}" for name, short in SHORT_NAMES.items()]
    aggregates += [
        f"{fn}({name}) AS {fn}_{SHORT_NAMES[name]}" for name in ("heart_rate", "spo2") for fn in ("min", "max")
    ]
    aggregates += ["count(*) AS event_count"] + [f"bool_or({trip}) AS {name}" for name, trip in trips.items()]
    grouped = readings.groupBy(F.window("timestamp", f"{minutes} minutes").alias("w"), "patient_id")
    made = {
        "window_start": F.col("w.start"),
        "window_end": F.col("w.end"),
        "anomaly_flags": flag_array({name: name for name in trips}),
    }
    windows = grouped.agg(*[F.expr(a) for a in aggregates])
    return windows.select(*[made[c].alias(c) if c in made else c for c in WINDOW.names])


def reading_alerts(readings: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """The alerts each single reading raises, in the fixed order."""
    return readings.withColumn("alerts", flag_array(reading_checks(limits)))
