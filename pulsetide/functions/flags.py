"""Threshold checks and the flags they raise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulsetide.params import AlertLimits


def checks(heart_rate: str, spo2: str, temperature: str, systolic_bp: str, limits: AlertLimits) -> dict[str, str]:
    """One condition per alert type, in the fixed order; null where not measured."""
    return {
        "TACHYCARDIA": f"{heart_rate} > {limits.hr_high}D",
        "HYPOXIA": f"{spo2} < {limits.spo2_low}D",
        "FEVER": f"{temperature} > {limits.temp_high}D",
        "HYPOTENSION": f"{systolic_bp} < {limits.sbp_low}D",
    }


def reading_checks(limits: AlertLimits) -> dict[str, str]:
    return checks("heart_rate", "spo2", "temperature", "systolic_bp", limits)


def average_checks(limits: AlertLimits) -> dict[str, str]:
    return checks("avg_hr", "avg_spo2", "avg_temp", "avg_systolic_bp", limits)


def flag_array(conditions: dict[str, str]) -> Column:
    flags = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in conditions.items())
    return F.expr(f"array_compact(array({flags}))")
