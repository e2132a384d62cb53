"""The daily risk report: one plan from readings and labs to scored rows."""

from __future__ import annotations

from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsetide.functions.clock import sim_date
from pulsetide.operators.clean import dedupe_readings
from pulsetide.operators.labs import accepted_rows, file_verdicts, normalize_labs
from pulsetide.operators.summaries import (
    as_json,
    build_reports,
    daily_vitals,
    lab_counts,
    lab_results_by_day,
    nest_summaries,
    on_days,
)
from pulsetide.params import Params, SimClock
from pulsetide.schemas import RESULT
from pulsetide.session import shared_folder, store
from pulsetide.sinks.keyed_table import KeyedTable
from pulsetide.sources.files import list_folder
from pulsetide.sources.lab_files import empty_files, headers, inventory, lab_file_verdicts, lab_rows, read_lab_lines
from pulsetide.sources.readings import read_archive_day


def risk_scores(
    readings: DataFrame, labs: DataFrame, first: date, last: date, params: Params = Params()
) -> DataFrame:
    """Scores of every patient-day from first to last, without the lists of results.

    Several days cost one plan, not one run each: the date is part of every key. ``labs``
    are single results, or those counted by day (``lab_results_by_day``).
    """
    vitals = daily_vitals(on_days(readings, "timestamp", first, last))
    dated = labs.where(F.col("report_date").between(first, last)) if "times" in labs.columns else on_days(labs, "collected_at", first, last)
    counts = lab_counts(dated)
    return build_reports(vitals, counts, params.limits, params.risk)


def risk_reports(
    readings: DataFrame, labs: DataFrame, first: date, last: date, params: Params = Params()
) -> DataFrame:
    """Report rows with nested summaries for every patient-day from first to last."""
    return nest_summaries(risk_scores(readings, labs, first, last, params))


class RunStatus(NamedTuple):
    report_date: date
    status: str  # skipped, waiting or ready


def run_status(
    spark: SparkSession, logical_time: datetime, lab_folder: str, clock: SimClock
) -> RunStatus:
    """Which simulated day a run is for, and whether it can go ahead.

    Days before the clock's start never get labs, so they are skipped, not waited for.
    """
    day = spark.range(1).select(sim_date(F.lit(logical_time), clock)).first()[0]
    if day < clock.sim_start:
        return RunStatus(day, "skipped")
    wanted = f"labs_{day.isoformat()}.csv"
    ready = any(e.name == wanted for e in list_folder(spark, lab_folder))
    return RunStatus(day, "ready" if ready else "waiting")


class InvalidLabFile(ValueError):
    """A lab file failed the strict check."""


def strict_labs(spark: SparkSession, path: str, report_date: date | None = None) -> DataFrame:
    """Normalized labs of the given file or folder; any invalid file, at any depth, is an error, an empty one too."""
    lines = read_lab_lines(spark, path)
    heads = store(headers(lines), shared_folder(spark, "lab-headers"))
    rows = lab_rows(lines, heads)
    verdicts = lab_file_verdicts(rows, heads, strict=True, report_date=report_date)
    folder = shared_folder(spark, "lab-verdicts")
    bad = store(verdicts.where(~F.col("accepted")).unionByName(empty_files(inventory(spark, path), heads)), folder)
    number = bad.count()
    if number or heads.isEmpty():
        some = "; ".join(f"{r.source_file}: {r.reason}" for r in bad.orderBy("source_file").take(5))
        raise InvalidLabFile(f"{number} invalid files, all in {folder}: {some}" if number else f"{path}: no_files")
    return normalize_labs(rows.where(~F.col("header_line")))


def valid_labs(raw: DataFrame, folder: str, strict: bool = True) -> DataFrame:
    """Normalized labs of accepted files only; the verdicts are stored in ``folder``.

    Reading the verdicts back gives Spark their true size: it broadcasts the
    rejected files while they are few, and the lab rows stay where they are.
    """
    return normalize_labs(accepted_rows(raw, store(file_verdicts(raw, strict), folder)))


def report_day(
    spark: SparkSession,
    archive: str,
    lab_folder: str,
    report_date: date,
    target: KeyedTable,
    version: int,
    params: Params = Params(),
) -> None:
    """One report date from archive and lab file into the report table; safe to run again."""
    # An archive that keeps late events may hold one more than once, and a day may hold files of several formats.
    readings = dedupe_readings(read_archive_day(spark, archive, report_date))
    labs = strict_labs(spark, f"{lab_folder}/labs_{report_date.isoformat()}.csv", report_date)
    store_run(readings, labs, report_date, report_date, target, version, params)


def store_run(
    readings: DataFrame,
    labs: DataFrame,
    first: date,
    last: date,
    target: KeyedTable,
    version: int,
    params: Params = Params(),
) -> None:
    """Reports of the days first..last, and every lab result behind them.

    The results come first, in a folder of the run's version, so a report never stands
    without them. They are rows beside the report, keyed by the result itself, whatever
    their number. A report row names the run it is from and has that run's results only: a
    run that has none for a patient leaves none, and one that fails midway changes nothing.
    The counts of a report are taken from the stored results, so labs are read and parsed once.
    """
    results = lab_results_by_day(on_days(labs, "collected_at", first, last))
    run = results.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("report_date")
    folder = f"{_results_folder(target)}/run_version={version}"
    run.parquet(folder)
    counted = target.spark.read.schema(results.schema).parquet(folder)
    store_reports(risk_reports(readings, counted, first, last, params), target, version)


def store_reports(reports: DataFrame, target: KeyedTable, version: int) -> None:
    """Stored summaries hold the counts of results; the results are rows of their own (``store_run``)."""
    stamped = as_json(reports).withColumns({"generated_at": F.current_timestamp(), "run_version": F.lit(version).cast("long")})
    target.write_changes(stamped, version)


def stored_results(spark: SparkSession, target: KeyedTable) -> DataFrame:
    """The lab results of the stored reports, each of the run its report is from; filters on the date prune folders."""
    runs = target.current().select("patient_id", "report_date", "run_version")
    results = spark.read.schema(RESULT).option("basePath", _results_folder(target)).parquet(_results_folder(target))
    return results.join(runs, ["patient_id", "report_date", "run_version"], "left_semi").select(*RESULT.names).drop("run_version")


def _results_folder(target: KeyedTable) -> str:
    return f"{target.path}/results"
