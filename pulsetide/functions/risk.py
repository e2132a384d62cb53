"""The daily risk score, as SQL text over the columns of a patient-day."""

from __future__ import annotations

from pulsetide.functions.flags import average_checks
from pulsetide.params import AlertLimits, RiskRules


def vital_burden(limits: AlertLimits) -> str:
    """Share of the measured checks that trip; 0 when nothing was measured."""
    conditions = average_checks(limits).values()
    tripped = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conditions)
    measured = " + ".join(f"CASE WHEN ({c}) IS NOT NULL THEN 1 ELSE 0 END" for c in conditions)
    return f"coalesce(try_divide({tripped}, {measured}), 0D)"


def lab_burden(abnormal: str, total: str) -> str:
    return f"least(coalesce({abnormal}, 0) / greatest(coalesce({total}, 0), 1), 1D)"


def trend_burden(direction: str, rules: RiskRules) -> str:
    """Burden of an optional trend; without one it is stable."""
    return f"CASE lower({direction}) WHEN 'worsening' THEN {rules.worsening}D WHEN 'mixed' THEN {rules.mixed}D ELSE 0D END"


def weighted_score(vitals: str, labs: str, trend: str, rules: RiskRules) -> str:
    """Score from 0 to 100, not yet rounded."""
    weights = f"{rules.vitals_weight}D * {vitals} + {rules.labs_weight}D * {labs} + {rules.trend_weight}D * {trend}"
    return f"least(100D, 100D * ({weights}))"


def risk_flag(score: str, rules: RiskRules) -> str:
    high, medium = rules.high_score, rules.medium_score
    return f"CASE WHEN {score} >= {high}D THEN 'HIGH' WHEN {score} >= {medium}D THEN 'MEDIUM' ELSE 'LOW' END"
