"""The speed layer over files: the same rules as the stream, in one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from pulsetide.operators.clean import clean_readings, dedupe_readings, is_clean, typed_readings
from pulsetide.operators.windows import window_vitals
from pulsetide.params import WINDOW_MINUTES, AlertLimits
from pulsetide.sinks.outputs import write_json_lines
from pulsetide.sources.readings import read_json_lines


def windows_of(
    raw: DataFrame, minutes: int = WINDOW_MINUTES, limits: AlertLimits = AlertLimits(), arrival: str | None = None
) -> DataFrame:
    """Raw readings to windows: clean, first copy of each event, aggregate."""
    return window_vitals(dedupe_readings(clean_readings(raw), arrival), minutes, limits)


def process_json_lines(spark: SparkSession, source: str, target: str) -> Row:
    """Windows of JSON-lines readings as JSON lines; returns accepted and rejected counts.

    The counts are observed while the windows are made, so the source is read once.
    """
    rejected, accepted = Observation(), Observation()
    typed = typed_readings(read_json_lines(spark, source)).observe(rejected, F.count_if(~is_clean()).alias("n"))
    distinct = dedupe_readings(typed.where(is_clean()).drop("unreadable"), "arrival").observe(accepted, F.count("*").alias("n"))
    write_json_lines(window_vitals(distinct), target)
    return Row(accepted=accepted.get["n"], rejected=rejected.get["n"])
