"""Daily summaries per patient, and the report made from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from pulsetide.functions import risk
from pulsetide.functions.parsing import finite
from pulsetide.functions.rounding import round_half_even, steady_mean
from pulsetide.params import SHORT_NAMES, AlertLimits, RiskRules
from pulsetide.schemas import LAB_TEST

DAY_KEY = ["patient_id", "report_date"]
METRICS = [f"{kind}_{short}" for short in SHORT_NAMES.values() for kind in ("avg", "min", "max")]

# Results per list of a patient-day, about. Every patient-day is split by the
# same rule; a list never grows with the data.
PAGE_ROWS = 1_000


def on_days(rows: DataFrame, time: str, first: date, last: date) -> DataFrame:
    """Rows of the days first..last as bounds on the raw column, so that scans skip row groups."""
    start, end = F.lit(first).cast("timestamp"), F.date_add(F.lit(last), 1).cast("timestamp")
    return rows.where((F.col(time) >= start) & (F.col(time) < end))


def daily_vitals(readings: DataFrame) -> DataFrame:
    """Count, averages and extremes per patient and day; only finite values count.

    A patient-day without any finite value has no summary, while an event
    without values counts for a patient-day that has some.
    """
    values = readings.where("patient_id IS NOT NULL AND patient_id <> ''").selectExpr(
        "patient_id", "CAST(`timestamp` AS DATE) AS report_date", *[f"{finite(v)} AS {v}" for v in SHORT_NAMES]
    )
    aggregates = [
        f"{value} AS {kind}_{short}"
        for v, short in SHORT_NAMES.items()
        for kind, value in (("avg", steady_mean(v)), ("min", f"min({v})"), ("max", f"max({v})"))
    ]
    days = values.groupBy(*DAY_KEY).agg(F.count("*").alias("event_count"), *[F.expr(a) for a in aggregates])
    measured = ", ".join(f"min_{short}" for short in SHORT_NAMES.values())
    return days.where(f"coalesce({measured}) IS NOT NULL").selectExpr(
        *DAY_KEY, "event_count", *[f"{round_half_even(m, 3)} AS {m}" for m in METRICS]
    )


def _dated(labs: DataFrame) -> DataFrame:
    return labs.withColumn("report_date", F.col("collected_at").cast("date"))


def lab_counts(labs: DataFrame) -> DataFrame:
    """Results and abnormal results per patient and day, of results or of those counted by day (``lab_results_by_day``)."""
    if "times" in labs.columns:
        abnormal = F.sum(F.when(F.col("is_abnormal"), F.col("times")).otherwise(0))
        return labs.groupBy(*DAY_KEY).agg(F.sum("times").alias("result_count"), abnormal.alias("abnormal_count"))
    return (
        _dated(labs)
        .groupBy(*DAY_KEY)
        .agg(F.count("*").alias("result_count"), F.count_if("is_abnormal").alias("abnormal_count"))
    )


def lab_test_pages(labs: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Every patient-day's results as (page, result, how often), with the patient-day's counts.

    Equal results are counted before the shuffle and the group key holds the
    result itself, so even one patient-day with most of the data spreads over
    all tasks. The page follows from the result's text, so a retry gives the same.
    """
    results = lab_results_by_day(labs)
    abnormal = F.sum(F.when(F.col("is_abnormal"), F.col("times")).otherwise(0))
    totals = results.groupBy(*DAY_KEY).agg(
        F.sum("times").alias("result_count"), abnormal.alias("abnormal_count"), F.count("*").alias("distinct_results")
    )
    text = F.md5(F.concat_ws(":", *LAB_TEST.names))
    number = F.conv(F.substring(text, 1, 8), 16, 10).cast("long")
    page = F.pmod(number, F.ceil(F.col("distinct_results") / F.lit(page_rows)))
    return results.join(totals, DAY_KEY).withColumn("page", page).drop("distinct_results")


def summarize_labs(labs: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Counts per patient and day beside its results as sorted lists, one row per list.

    A patient-day has as many lists as its distinct results need; together they
    hold every result once, with how often it occurs.
    """
    tests = F.array_sort(F.collect_list(F.struct(*LAB_TEST.names, "times"))).alias("tests")
    return lab_test_pages(labs, page_rows).groupBy(*DAY_KEY, "page", "result_count", "abnormal_count").agg(tests)


def lab_results_by_day(labs: DataFrame) -> DataFrame:
    """Every result of every patient-day with how often it occurs, by one rule at any size."""
    return _dated(labs).groupBy(*DAY_KEY, *LAB_TEST.names).agg(F.count("*").alias("times"))


def score_patients(rows: DataFrame, limits: AlertLimits = AlertLimits(), rules: RiskRules = RiskRules()) -> DataFrame:
    """Score rows that already hold averages and lab counts side by side."""
    trend = "trend_direction" if "trend_direction" in rows.columns else "CAST(NULL AS STRING)"
    # Step by step: rounding uses its input many times, and as a column of its
    # own the input is computed once and the generated code stays small.
    burdens = {
        "vital_burden": risk.vital_burden(limits),
        "lab_burden": risk.lab_burden("abnormal_count", "result_count"),
        "trend_burden": risk.trend_burden(trend, rules),
    }
    weighted = risk.weighted_score("vital_burden", "lab_burden", "trend_burden", rules)
    return (
        rows.selectExpr("*", *[f"{sql} AS {name}" for name, sql in burdens.items()])
        .selectExpr(*rows.columns, f"{weighted} AS weighted_score")
        .selectExpr(*rows.columns, f"{round_half_even('weighted_score', 2)} AS risk_score")
        .selectExpr("*", f"{risk.risk_flag('risk_score', rules)} AS risk_flag")
    )


def build_reports(
    vitals: DataFrame, labs: DataFrame, limits: AlertLimits = AlertLimits(), rules: RiskRules = RiskRules()
) -> DataFrame:
    """Score every patient-day that has vitals, labs or both.

    Both sides hold one row per key, and each arrives partitioned by it from
    its aggregation. An optional ``trend_direction`` on the vitals side is scored.
    """
    return score_patients(vitals.join(labs, DAY_KEY, "full"), limits, rules)


def nest_summaries(reports: DataFrame) -> DataFrame:
    """Report rows with the two summaries as structs.

    Without vitals the summary is empty, without labs it counts zero. Absent
    metrics are null fields, which ``to_json`` leaves out. Results are rows of
    their own (``lab_results_by_day``): a report row does not grow with them.
    """
    vital_fields = ["event_count", *METRICS] + [c for c in ("trend_direction",) if c in reports.columns]
    counts = [f"coalesce({c}, 0L) AS {c}" for c in ("result_count", "abnormal_count")]
    return reports.selectExpr(
        *DAY_KEY,
        f"struct({', '.join(vital_fields)}) AS vitals_summary",
        f"struct({', '.join(counts)}) AS lab_summary",
        "CAST(risk_score AS DECIMAL(5, 2)) AS risk_score",
        "risk_flag",
    )


def as_json(reports: DataFrame) -> DataFrame:
    return reports.withColumns({c: F.to_json(c) for c in ("vitals_summary", "lab_summary")})
