"""Schemas of the relations. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

from pulsetide.params import LAB_COLUMNS, VITALS


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


# As it arrives: vitals and time are text, so that a bad value can be told
# from a missing one.
RAW_READING = T.StructType(_fields(T.StringType(), "event_id", "patient_id", *VITALS, "timestamp"))
# The message a reading was decoded from, where it is kept.
RAW_TEXT = "raw_text"

READING = T.StructType(
    _fields(T.StringType(), "event_id", "patient_id")
    + _fields(T.DoubleType(), *VITALS)
    + _fields(T.TimestampType(), "timestamp")
)

ARCHIVE = T.StructType(READING.fields + _fields(T.TimestampType(), "ingested_at") + _fields(T.DateType(), "date"))

WINDOW = T.StructType(
    _fields(T.StringType(), "patient_id")
    + _fields(T.TimestampType(), "window_start", "window_end")
    + _fields(T.DoubleType(), "avg_hr", "avg_spo2", "avg_systolic_bp", "avg_diastolic_bp", "avg_temp")
    + _fields(T.DoubleType(), "min_hr", "max_hr", "min_spo2", "max_spo2")
    + _fields(T.LongType(), "event_count")
    + _fields(T.ArrayType(T.StringType()), "anomaly_flags")
)

EPISODE = T.StructType(
    _fields(T.StringType(), "alert_id", "patient_id", "alert_type")
    + _fields(T.TimestampType(), "triggered_at", "resolved_at")
)

RAW_LAB = T.StructType(_fields(T.StringType(), *LAB_COLUMNS))

LAB = T.StructType(
    _fields(T.StringType(), "patient_id", "test_type")
    + _fields(T.DoubleType(), "result_value")
    + _fields(T.StringType(), "reference_range")
    + _fields(T.DoubleType(), "reference_low", "reference_high")
    + _fields(T.TimestampType(), "collected_at")
    + _fields(T.BooleanType(), "is_abnormal")
)

PATIENT = T.StructType(_fields(T.StringType(), "patient_id", "ward") + _fields(T.DateType(), "admit_date"))

LAB_TEST = T.StructType(
    _fields(T.StringType(), "test_type") + _fields(T.DoubleType(), "result_value") + _fields(T.BooleanType(), "is_abnormal")
)

REPORT = T.StructType(
    _fields(T.StringType(), "patient_id")
    + _fields(T.DateType(), "report_date")
    + _fields(T.StringType(), "vitals_summary", "lab_summary")
    + _fields(T.DecimalType(5, 2), "risk_score")
    + _fields(T.StringType(), "risk_flag")
    + _fields(T.TimestampType(), "generated_at")
    + _fields(T.LongType(), "run_version")
)

# One lab result of a stored report, and how often it occurs.
RESULT = T.StructType(
    _fields(T.StringType(), "patient_id")
    + _fields(T.DateType(), "report_date")
    + LAB_TEST.fields
    + _fields(T.LongType(), "times", "run_version")
)
