"""Parameters of the rules. They end up as literals in the plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import date, datetime

# The names and limits below are part of the data contract.
VITALS = ("heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature")

# Short names used in aggregate columns (avg_hr, min_spo2, ...).
SHORT_NAMES = {
    "heart_rate": "hr",
    "spo2": "spo2",
    "systolic_bp": "systolic_bp",
    "diastolic_bp": "diastolic_bp",
    "temperature": "temp",
}

# Physically possible values, both ends included.
VALID_RANGES = {
    "heart_rate": (30.0, 220.0),
    "spo2": (50.0, 100.0),
    "systolic_bp": (60.0, 250.0),
    "diastolic_bp": (30.0, 150.0),
    "temperature": (30.0, 43.0),
}

ALERT_TYPES = ("TACHYCARDIA", "HYPOXIA", "FEVER", "HYPOTENSION")
RISK_FLAGS = ("LOW", "MEDIUM", "HIGH")
LAB_COLUMNS = ("patient_id", "test_type", "result_value", "reference_range", "collected_at")
PATIENT_COLUMNS = ("patient_id", "ward", "admit_date")

WINDOW_MINUTES = 5
WATERMARK = "2 minutes"


@dataclass(frozen=True)
class AlertLimits:
    """A reading trips when it lies strictly beyond its limit."""

    hr_high: float = 120.0
    spo2_low: float = 90.0
    temp_high: float = 38.5
    sbp_low: float = 90.0


@dataclass(frozen=True)
class RiskRules:
    medium_score: float = 30.0
    high_score: float = 70.0
    vitals_weight: float = 0.6
    labs_weight: float = 0.3
    trend_weight: float = 0.1
    worsening: float = 1.0
    mixed: float = 0.5


@dataclass(frozen=True)
class SimClock:
    """One simulated day passes every ``day_seconds`` real seconds."""

    real_start: datetime
    sim_start: date
    day_seconds: float = 300.0


@dataclass(frozen=True)
class Params:
    limits: AlertLimits = field(default_factory=AlertLimits)
    risk: RiskRules = field(default_factory=RiskRules)


def _filled(kind, values: Mapping[str, object]):
    names = {f.name for f in fields(kind)}
    return kind(**{k: float(v) for k, v in values.items() if k in names})


def load_params(path: str) -> Params:
    """Read a YAML file with ``vitals:`` and ``risk:`` sections, or flat limits."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return params_from(yaml.safe_load(handle) or {})


def params_from(values: Mapping[str, object]) -> Params:
    limits = values.get("vitals", values)
    return Params(_filled(AlertLimits, limits), _filled(RiskRules, values.get("risk", {})))
