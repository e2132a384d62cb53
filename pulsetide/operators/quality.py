"""Structural checks of readings, dead letters, and checks of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsetide.functions.parsing import parse_once, text_id, to_instant
from pulsetide.operators.clean import is_clean, typed_readings
from pulsetide.params import ALERT_TYPES, RISK_FLAGS, VITALS
from pulsetide.schemas import RAW_TEXT

# Fixed value: the reason the dead-letter contract names.
FAILED_VALIDATION = "failed_validation"


def with_validity(readings: DataFrame) -> DataFrame:
    """Add ``invalid_detail``: why a reading must not be published, or null."""
    text = dict(readings.dtypes)["timestamp"] == "string"
    instant = to_instant("`timestamp`") if text else "`timestamp`"
    given = ", ".join(f"CAST({v} AS STRING)" for v in VITALS)
    patient = f"{text_id('patient_id')} IS NULL"
    # Only what has no patient can be broken text, so few messages are parsed for it.
    broken = f"WHEN {patient} AND try_parse_json({RAW_TEXT}) IS NULL THEN 'undecodable' " if RAW_TEXT in readings.columns else ""
    detail = (
        f"CASE {broken}WHEN {patient} THEN 'missing_patient' "
        f"WHEN ({instant}) IS NULL THEN 'bad_timestamp' "
        f"WHEN coalesce({given}) IS NULL THEN 'no_vitals' END"
    )
    return parse_once(readings, {"invalid_detail": detail})


def publishable(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("invalid_detail").isNull()).drop("invalid_detail")


def dead_letters(checked: DataFrame, payload: list[str] | None = None) -> DataFrame:
    """Rejected readings as key and value of the dead-letter contract."""
    payload = payload or [c for c in checked.columns if c != "invalid_detail"]
    return checked.where(F.col("invalid_detail").isNotNull()).select(
        F.expr(f"coalesce({text_id('patient_id')}, 'unknown')").alias("key"),
        (sent_value() if RAW_TEXT in payload else rejected_value(payload)).alias("value"),
        F.lit(FAILED_VALIDATION).alias("error_reason"),
        "invalid_detail",
        *payload,
    )


def rejected_value(payload: list[str]) -> Column:
    """The rejected reading whole, missing fields as null, with the reason."""
    whole = F.struct(F.struct(*payload).alias("raw_payload"), F.lit(FAILED_VALIDATION).alias("error_reason"))
    return F.to_json(whole, {"ignoreNullFields": "false"})


def sent_value() -> Column:
    """The rejected message as it was sent, character by character; as a JSON text where it is no JSON itself."""
    reason = F.lit(FAILED_VALIDATION)
    whole = F.concat(F.lit('{"raw_payload":'), F.col(RAW_TEXT), F.lit(f',"error_reason":"{FAILED_VALIDATION}"}}'))
    text = F.to_json(F.struct(F.col(RAW_TEXT).alias("raw_payload"), reason.alias("error_reason")), {"ignoreNullFields": "false"})
    return F.when(F.try_parse_json(F.col(RAW_TEXT)).isNotNull(), whole).otherwise(text)


def run_counts(readings: DataFrame) -> DataFrame:
    """Accepted (clean and distinct) and rejected readings of a run, in one pass.

    Rejected readings share the null key; they are counted before the shuffle.
    """
    accepted_id = F.when(is_clean(), F.col("event_id")).alias("accepted_id")
    per_id = typed_readings(readings).groupBy(accepted_id).agg(F.count("*").alias("n"))
    return per_id.selectExpr(
        "count(accepted_id) AS accepted", "coalesce(sum(CASE WHEN accepted_id IS NULL THEN n END), 0) AS rejected"
    )


def check_rules() -> dict[str, dict[str, Column]]:
    """Named CHECK rules per table. Like SQL, a null outcome passes."""
    c = F.col
    return {
        "vitals_live": {
            "window_end_after_start": c("window_end") > c("window_start"),
            "event_count_not_negative": c("event_count") >= 0,
        },
        "lab_results": {"low_not_above_high": c("reference_low") <= c("reference_high")},
        "daily_risk_report": {
            "score_in_0_100": c("risk_score").between(0, 100),
            "known_risk_flag": c("risk_flag").isin(*RISK_FLAGS),
        },
        "alerts_log": {
            "known_alert_type": c("alert_type").isin(*ALERT_TYPES),
            "resolved_not_before_triggered": c("resolved_at") >= c("triggered_at"),
        },
    }


# Keys and required columns of the stored tables.
PRIMARY_KEYS = {
    "patients": ["patient_id"],
    "vitals_live": ["patient_id", "window_start"],
    "lab_results": ["patient_id", "test_type", "collected_at"],
    "daily_risk_report": ["patient_id", "report_date"],
    "alerts_log": ["alert_id"],
}
REQUIRED = {
    "patients": ["patient_id", "ward", "admit_date"],
    "vitals_live": ["patient_id", "window_start", "window_end", "event_count", "anomaly_flags"],
    "lab_results": [
        "patient_id", "test_type", "result_value", "reference_range",
        "reference_low", "reference_high", "collected_at", "is_abnormal",
    ],
    "daily_risk_report": ["patient_id", "report_date", "vitals_summary", "lab_summary", "risk_score", "risk_flag", "generated_at"],
    "alerts_log": ["alert_id", "patient_id", "alert_type", "triggered_at"],
}


def _counts_as_rows(table: str, counts: DataFrame, names: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*pairs)))


def check_violations(table: str, rows: DataFrame) -> DataFrame:
    """Violations of each CHECK rule of a table; one pass, one small row per task."""
    rules = check_rules()[table]
    counts = rows.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return _counts_as_rows(table, counts, list(rules))


def null_violations(table: str, rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls in each required column of a table; a column the rows lack is null in all of them."""
    names = columns or REQUIRED[table]
    given = {n: F.col(n) if n in rows.columns else F.lit(None) for n in names}
    counts = rows.agg(*[F.count_if(value.isNull()).alias(n) for n, value in given.items()])
    return _counts_as_rows(table, counts, names)


def key_duplicates(table: str, rows: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*PRIMARY_KEYS[table]).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def orphans(rows: DataFrame, patients: DataFrame) -> DataFrame:
    """Patients a table refers to that do not exist, with their rows.

    Counting first leaves one row per patient for the anti join, however many
    rows one patient has.
    """
    referred = rows.where(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(F.count("*").alias("row_count"))
    return referred.join(patients.select("patient_id"), "patient_id", "left_anti")
