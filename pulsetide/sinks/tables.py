"""The stored tables with their keys."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pulsetide.operators.quality import PRIMARY_KEYS
from pulsetide.schemas import EPISODE, LAB, PATIENT, REPORT, WINDOW
from pulsetide.sinks.keyed_table import KeyedTable


def live_table(spark: SparkSession, path: str) -> KeyedTable:
    """In folders by the window's date, so that a micro-batch reads only the days it touches."""
    return KeyedTable(
        spark, path, WINDOW, PRIMARY_KEYS["vitals_live"], dates={"window_date": "CAST(window_start AS DATE)"}
    )


def alert_table(spark: SparkSession, path: str) -> KeyedTable:
    """Keyed by what the alert id is made of, so that filters on these columns reach the scan."""
    return KeyedTable(spark, path, EPISODE, ["patient_id", "alert_type", "triggered_at"])


def patient_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, PATIENT, PRIMARY_KEYS["patients"])


def lab_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, LAB, PRIMARY_KEYS["lab_results"])


def report_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, REPORT, PRIMARY_KEYS["daily_risk_report"], ["report_date"])
