"""Cleaning and deduplication of readings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pulsetide.functions.parsing import parse_once, text_id, to_instant, to_number
from pulsetide.params import VALID_RANGES, VITALS, WATERMARK


def typed_readings(readings: DataFrame) -> DataFrame:
    """Ids as text, vitals as doubles, time as timestamp, and ``unreadable``.

    A reading is unreadable when a vital is given that is no number. Columns
    that are typed already only pass through.
    """
    kinds = dict(readings.dtypes)
    texts = [v for v in VITALS if kinds[v] == "string"]
    typed = {name: text_id(name) for name in ("event_id", "patient_id")}
    typed |= {v: to_number(v) if v in texts else f"CAST({v} AS DOUBLE)" for v in VITALS}
    time = "`timestamp`"
    typed["timestamp"] = to_instant(time) if kinds["timestamp"] == "string" else f"CAST({time} AS TIMESTAMP)"
    lost = " OR ".join(f"{v} IS NOT NULL AND {to_number(v)} IS NULL" for v in texts)
    typed["unreadable"] = lost or "false"
    if texts or kinds["timestamp"] == "string":
        return parse_once(readings, typed)
    return readings.withColumns({name: F.expr(sql) for name, sql in typed.items()})


def is_clean(ranges: Mapping[str, tuple[float, float]] = VALID_RANGES) -> Column:
    """For typed readings: identity and time are there, and every given vital is in its range.

    A missing vital is fine. NaN sorts above every range.
    """
    known = "event_id IS NOT NULL AND patient_id IS NOT NULL AND `timestamp` IS NOT NULL AND NOT unreadable"
    possible = [f"({v} IS NULL OR {v} BETWEEN {lo}D AND {hi}D)" for v, (lo, hi) in ranges.items()]
    return F.expr(" AND ".join([known, *possible]))


def clean_readings(readings: DataFrame, ranges: Mapping[str, tuple[float, float]] = VALID_RANGES) -> DataFrame:
    return typed_readings(readings).where(is_clean(ranges)).drop("unreadable")


def dedupe_readings(readings: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per event_id: the first to arrive, else the smallest.

    ``min`` over a struct combines on the map side, so a million copies of one
    event shrink to one row per task before the shuffle.
    """
    order = ([arrival] if arrival else []) + ["timestamp"]
    rest = [c for c in readings.columns if c not in order + ["event_id"]]
    first = readings.groupBy("event_id").agg(F.min(F.struct(*order, *rest)).alias("first"))
    kept = [c for c in readings.columns if c != arrival]
    return first.select(*[c if c == "event_id" else f"first.{c}" for c in kept])


def dedupe_stream(readings: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """First arrival per event_id; state leaves with the watermark."""
    return readings.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["event_id"])
