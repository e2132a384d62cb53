"""The questions a dashboard asks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from pulsetide.operators.episodes import open_alerts
from pulsetide.operators.upsert import latest_by_key
from pulsetide.params import RISK_FLAGS


def latest_windows(windows: DataFrame) -> DataFrame:
    return latest_by_key(windows, ["patient_id"], "window_start")


def ward_snapshot(windows: DataFrame, episodes: DataFrame, patients: DataFrame, ward: str | None = None) -> DataFrame:
    """Latest window of each known patient, with ward and whether any alert is open.

    Every join side holds one row per patient by then. Spark picks broadcast by
    the measured size, so no hint is given.
    """
    known = patients.select("patient_id", "ward")
    if ward is not None:
        known = known.where(F.col("ward") == ward)
    alerting = open_alerts(episodes).select("patient_id").distinct().withColumn("active_alert", F.lit(True))
    return (
        latest_windows(windows)
        .join(known, "patient_id")
        .join(alerting, "patient_id", "left")
        .select(
            "patient_id", "ward", "window_start", "window_end",
            "avg_hr", "avg_spo2", "avg_systolic_bp", "avg_diastolic_bp", "avg_temp",
            "event_count", "anomaly_flags",
            F.coalesce("active_alert", F.lit(False)).alias("active_alert"),
        )
    )


class UnknownPatient(LookupError):
    """The patient is not in the patients table."""


def require_patient(patients: DataFrame, patient_id: str) -> None:
    if patients.where(F.col("patient_id") == patient_id).isEmpty():
        raise UnknownPatient(patient_id)


def alerts_by_status(episodes: DataFrame, status: str = "all") -> DataFrame:
    if status not in ("active", "resolved", "all"):
        raise ValueError(f"status must be active, resolved or all, not {status!r}")
    if status == "all":
        return episodes
    resolved = F.col("resolved_at").isNotNull()
    return episodes.where(resolved if status == "resolved" else ~resolved)


def patient_alerts(episodes: DataFrame, patients: DataFrame, patient_id: str, status: str = "all") -> DataFrame:
    """One patient's alerts, newest first; an unknown patient is an error, not an empty list."""
    require_patient(patients, patient_id)
    mine = episodes.where(F.col("patient_id") == patient_id)
    return alerts_by_status(mine, status).orderBy(F.desc("triggered_at"))


def daily_report(reports: DataFrame, report_date: date, risk_flag: str | None = None) -> DataFrame:
    """A day's report, highest score first; empty when there is none."""
    if risk_flag is not None and risk_flag not in RISK_FLAGS:
        raise ValueError(f"risk_flag must be one of {RISK_FLAGS}, not {risk_flag!r}")
    day = reports.where(F.col("report_date") == F.lit(report_date))
    if risk_flag is not None:
        day = day.where(F.col("risk_flag") == risk_flag)
    return day.orderBy(F.desc("risk_score"), "patient_id")


def report_counts(reports: DataFrame) -> DataFrame:
    """Rows of each day's report."""
    return reports.groupBy("report_date").agg(F.count("*").alias("report_count"))


def last_data_received(windows: DataFrame) -> DataFrame:
    return windows.agg(F.max("window_end").alias("last_data_received"))
