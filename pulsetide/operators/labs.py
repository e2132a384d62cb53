"""Checks and normal form of lab results."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from pulsetide.functions.parsing import parse_once, reference_high, reference_low, text_id, to_instant, to_number
from pulsetide.schemas import LAB

def typed_labs(raw: DataFrame) -> DataFrame:
    """Text rows with typed columns and the bounds of the reference range."""
    return parse_once(
        raw,
        {
            "patient_id": text_id("patient_id"),
            "test_type": text_id("test_type"),
            "result_value": to_number("result_value"),
            "reference_low": reference_low("reference_range"),
            "reference_high": reference_high("reference_range"),
            "collected_at": to_instant("collected_at"),
        },
    )


def lab_row_error(strict: bool = True, report_date: date | None = None) -> Column:
    """Why a typed lab row is invalid, or null.

    The landing check looks at ids and the result only; the strict check also
    wants a range, a collection time and, when given, the report date.
    """
    rules = {"missing_id": "patient_id IS NULL OR test_type IS NULL", "result_not_numeric": "result_value IS NULL"}
    if strict:
        rules["bad_reference_range"] = "reference_low IS NULL OR reference_high IS NULL"
        rules["reference_range_reversed"] = "reference_low > reference_high"
        rules["bad_collected_at"] = "collected_at IS NULL"
        if report_date is not None:
            rules["outside_report_date"] = f"CAST(collected_at AS DATE) <> DATE '{report_date.isoformat()}'"
    cases = " ".join(f"WHEN {bad} THEN '{name}'" for name, bad in rules.items())
    return F.expr(f"CASE {cases} END")


def normalize_labs(raw: DataFrame) -> DataFrame:
    """Typed lab results; expects rows that passed the strict check."""
    return with_abnormal(typed_labs(raw)).select(*LAB.names)


def with_abnormal(typed: DataFrame) -> DataFrame:
    """Out of range, strictly. NaN sorts above every number in Spark, but is not abnormal."""
    beyond = "NOT isnan(result_value) AND (result_value < reference_low OR result_value > reference_high)"
    return typed.withColumn("is_abnormal", F.expr(beyond))


def file_verdicts(rows: DataFrame, strict: bool = True, report_date: date | None = None) -> DataFrame:
    """One row per file: one bad row rejects it. Counts combine on the map side."""
    error = lab_row_error(strict, report_date)
    return (
        typed_labs(rows)
        .select("source_file", error.alias("row_error"))
        .groupBy("source_file")
        .agg(F.count("*").alias("row_count"), F.count("row_error").alias("bad_rows"))
        .withColumn("accepted", F.expr("bad_rows = 0"))
    )


def accepted_rows(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of accepted files.

    Rejected files are the few, so they are the side to be joined away: it
    stays small enough for Spark to broadcast by its measured size, and a file
    with a third of all rows is not shuffled then.
    """
    return rows.join(verdicts.where("NOT accepted").select("source_file"), "source_file", "left_anti")
