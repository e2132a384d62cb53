"""The engine's inputs made from the star-schema test tables (see FIXTURES.md).

The tables are clean, so missing ids, bad text and duplicates are added by
rules on the ids. Only the inputs are made here; every query then runs on all
of their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsetide.params import VITALS
from pulsetide.session import use_utc


# Some readings name a patient that no table of patients has.
UNKNOWN = "900000000 + user_id"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def patient_name(number: str) -> str:
    """Zero-padded to six digits; longer numbers stay whole."""
    text = f"CAST({number} AS STRING)"
    return f"concat('P', lpad({text}, greatest(length({text}), 6), '0'))"


def readings_from_events(events: DataFrame) -> DataFrame:
    """One reading per event, before duplication; each carries one vital."""
    return events.selectExpr(
        "event_id AS source_id",
        "CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS STRING) END AS event_id",
        f"CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 89 = 0 THEN {patient_name(UNKNOWN)} "
        f"ELSE {patient_name('user_id')} END AS patient_id",
        "CASE WHEN event_type = 'click' THEN 60 + value END AS heart_rate",
        "CASE WHEN event_type = 'error' THEN 100 - value / 4 END AS spo2",
        "CASE WHEN event_type = 'purchase' THEN 160 - value END AS systolic_bp",
        "CASE WHEN event_type = 'signup' THEN 60 + value / 2 END AS diastolic_bp",
        "CASE WHEN event_type = 'view' THEN 36 + value / 20 END AS temperature",
        "CAST(ts AS TIMESTAMP) AS `timestamp`",
    )


def vitals_from_events(events: DataFrame) -> DataFrame:
    copies = "explode(CASE WHEN source_id % 200 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    return readings_from_events(events).selectExpr("*", copies).drop("copy", "source_id")


def vitals_raw(spark: SparkSession, folder: str) -> DataFrame:
    return vitals_from_events(table(spark, folder, "events"))


def dirty_readings(events: DataFrame, *others: str) -> DataFrame:
    """Readings as a producer sees them: text time, some of it junk, some without vitals."""
    iso = "date_format(`timestamp`, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx\")"
    return readings_from_events(events).selectExpr(
        "event_id",
        "patient_id",
        *[f"CASE WHEN source_id % 109 <> 0 THEN {v} END AS {v}" for v in VITALS],
        f"CASE WHEN source_id % 107 = 0 THEN 'not-a-date' ELSE {iso} END AS `timestamp`",
        "`timestamp` AS received_at",
        *others,
    )


def readings_raw(spark: SparkSession, folder: str) -> DataFrame:
    return dirty_readings(table(spark, folder, "events"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Dirty readings as messages of JSON text: a heart rate as text, fields that no column knows, every 113th cut off."""
    events = table(spark, folder, "events")
    rows = dirty_readings(events, "source_id AS event_number")
    vital = f"CAST(coalesce({', '.join(VITALS)}) AS STRING)"
    quoted = "coalesce(concat('\"', {0}, '\"'), 'null')"
    parts = [
        "'{\"event_id\": '", "event_number", "', \"patient_id\": '", quoted.format("patient_id"),
        "', \"vital\": '", f"coalesce({vital}, 'null')", "', \"heart_rate\": '", quoted.format("CAST(heart_rate AS STRING)"),
        "', \"timestamp\": \"'", "`timestamp`", "'\", \"device\": {\"id\": '", "event_number % 7", "', \"tag\": \"a'", "chr(92)", "'\"b\"}}'",
    ]
    text = rows.selectExpr("event_number", f"concat({', '.join(parts)}) AS value")
    return text.selectExpr("CASE WHEN event_number % 113 = 0 THEN left(value, 40) ELSE value END AS value")


def _patient_count(spark: SparkSession, folder: str) -> Column:
    return table(spark, folder, "events").agg(F.max("user_id") + 1).scalar()


def patients(spark: SparkSession, folder: str) -> DataFrame:
    """All customers as patients; some readings name others."""
    return table(spark, folder, "customer").selectExpr(
        f"{patient_name('c_custkey')} AS patient_id",
        "c_mktsegment AS ward",
        "date_add(DATE '2023-12-01', CAST(c_custkey % 30 AS INT)) AS admit_date",
    )


def _lab_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % _patient_count(spark, folder)).alias("patient")
    )
    lines = table(spark, folder, "lineitem").join(orders, "l_orderkey")
    return lines.selectExpr("*", "date_add(DATE '2024-01-01', CAST(l_orderkey % 30 AS INT)) AS day")


def _lab_columns(result: str, reference: str) -> list[str]:
    return [
        f"{patient_name('patient')} AS patient_id",
        "concat(l_returnflag, l_linestatus) AS test_type",
        f"{result} AS result_value",
        f"{reference} AS reference_range",
        "CAST(day AS STRING) AS collected_at",
        "concat('labs_', CAST(day AS STRING), '.csv') AS source_file",
    ]


def labs(spark: SparkSession, folder: str) -> DataFrame:
    """Valid lab rows, as text."""
    columns = _lab_columns("CAST(l_quantity AS STRING)", "'5.0-45.0'")
    return _lab_lines(spark, folder).selectExpr(*columns, "l_orderkey", "l_linenumber")


def labs_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Lab rows with bad results in one file and bad ranges in another."""
    result = "CASE WHEN l_orderkey % 1500 = 17 THEN 'n/a' ELSE CAST(l_quantity AS STRING) END"
    reference = "CASE WHEN l_orderkey % 1500 = 29 THEN 'bad' ELSE '5.0-45.0' END"
    return _lab_lines(spark, folder).selectExpr(*_lab_columns(result, reference))
