import csv
import json
import re
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.queries import _small_blocks
from pulsetide.operators import health, labs as lab, quality
from pulsetide.operators.serving import daily_report
from pulsetide.operators.summaries import (
    as_json,
    build_reports,
    daily_vitals,
    lab_counts,
    lab_results_by_day,
    lab_test_pages,
    nest_summaries,
    summarize_labs,
)
from pulsetide.params import SimClock
from pulsetide.plans import daily_report as daily
from pulsetide.schemas import ARCHIVE, LAB, RAW_LAB, READING
from pulsetide.sinks.tables import patient_table, report_table
from pulsetide.sinks.outputs import archive_rows, replace_day, write_by_date
from pulsetide.sources.lab_files import CLOSING_LINE, WHOLE_LINE, empty_files, headers, inventory, lab_file_verdicts, lab_rows, read_lab_lines, with_line_breaks
from pulsetide.sources.patients import read_patients
from pulsetide.streaming.lab_intake import intake_verdicts, start_lab_intake
from tests.conftest import utc

DAY = date(2026, 1, 5)
HEAD = "patient_id,test_type,result_value,reference_range,collected_at"
GOOD = "P001,WBC,7.5,4.0-11.0,2026-01-05T00:00:00+00:00"
FILES = {
    "good.csv": f"{HEAD}\r\n{GOOD}\r\n",
    "reordered.csv": "collected_at,result_value,patient_id,test_type,reference_range\n2026-01-05,12,P002,WBC,4-11\n",
    "wrong_columns.csv": "patient_id,test_type,result_value\nP001,WBC,7.5\n",
    "extra_column.csv": f"{HEAD},ward\n{GOOD},A\n",
    "not_numeric.csv": f"{HEAD}\n{GOOD}\nP001,WBC,not_a_number,4.0-11.0,2026-01-05\n",
    "short_row.csv": f"{HEAD}\nP001,WBC\n",
    "no_patient.csv": f"{HEAD}\n,WBC,7,4-11,2026-01-05\n",
    "header_only.csv": f"{HEAD}\n",
    "header_twice.csv": f"{HEAD}\n{GOOD}\n{HEAD}\n",
    "blank_line.csv": f"{HEAD}\n\n{GOOD}\n",
    "quoted.csv": f'{HEAD}\n"P,3","W ""B""",7.5,4-11,2026-01-05\n',
    "quoted_header.csv": '"patient_id","test_type","result_value","reference_range","collected_at"\n' + GOOD + "\n",
    "column_twice.csv": f"{HEAD},ward\n{GOOD},A\n".replace("ward", "patient_id"),
    "bad_range.csv": f"{HEAD}\nP001,WBC,7,bad,2026-01-05\n",
    "reversed_range.csv": f"{HEAD}\nP001,WBC,7,11-4,2026-01-05\n",
    "bad_time.csv": f"{HEAD}\nP001,WBC,7,4-11,yesterday\n",
    "other_day.csv": f"{HEAD}\nP001,WBC,7,4-11,2026-01-06\n",
    "broken_field.csv": f'{HEAD}\n"P\n\n,1","W ""B""\r\n\n",7.5,4-11,2026-01-05\n{GOOD}\n',
    "broken_bad.csv": f'{HEAD}\nP1,"W\nB",seven,4-11,2026-01-05\n',
    "quote_inside.csv": f'{HEAD}\nP1,5" pipe,7,4-11,2026-01-05\nP2,5" pipe,8,4-11,2026-01-05\n',
    "blanks.csv": f"{HEAD}\n{GOOD}\n   \n",
    "only_blank.csv": "\n\n",
    "only_blanks.csv": "  \n",
    "empty.csv": "",
    "deep/er/empty_below.csv": "",
    "deep/er/good_below.csv": f"{HEAD}\n{GOOD}\n",
    "deep/only_blank_below.csv": "\n",
}
LENIENT = {"good", "reordered", "header_only", "blank_line", "quoted", "quoted_header", "bad_range", "reversed_range", "bad_time", "other_day",
           "broken_field", "quote_inside", "good_below"}
STRICT = {"good", "reordered", "header_only", "blank_line", "quoted", "quoted_header", "broken_field", "quote_inside", "good_below"}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for name, text in FILES.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(text.encode())
    return str(folder)


def name_of(path):
    return path.rsplit("/", 1)[-1].removesuffix(".csv")


@pytest.mark.parametrize("strict, expected", [(False, LENIENT), (True, STRICT)])
def test_file_verdicts(spark, landing, strict, expected):
    lines = read_lab_lines(spark, landing)
    heads = headers(lines)
    verdicts = lab_file_verdicts(lab_rows(lines, heads), heads, strict, DAY).unionByName(empty_files(inventory(spark, landing), heads))
    got = {name_of(r.source_file): r.accepted for r in verdicts.collect()}
    assert {n for n, ok in got.items() if ok} == expected
    assert len(got) == len(FILES)


def test_columns_are_found_by_name(spark, landing):
    rows = daily.strict_labs(spark, f"{landing}/reordered.csv", DAY).collect()
    assert [(r.patient_id, r.test_type, r.result_value, r.reference_low, r.is_abnormal) for r in rows] == [("P002", "WBC", 12.0, 4.0, True)]
    quoted = daily.strict_labs(spark, f"{landing}/quoted.csv", DAY).first()
    assert (quoted.patient_id, quoted.test_type) == ("P,3", 'W "B"')


@pytest.mark.parametrize("name", ["not_numeric", "other_day", "wrong_columns", "empty"])
def test_invalid_file_is_an_error(spark, landing, name):
    with pytest.raises(daily.InvalidLabFile):
        daily.strict_labs(spark, f"{landing}/{name}.csv", DAY)


@pytest.mark.parametrize("strict, expected", [(False, LENIENT), (True, STRICT | {"other_day"})])
def test_intake_stream(spark, landing, tmp_path, strict, expected):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        start_lab_intake(spark, landing, out, checkpoint, strict, available_now=True, files_per_trigger=4).awaitTermination()
    verdicts = intake_verdicts(spark, landing, out).collect()
    assert {name_of(r.source_file) for r in verdicts if r.accepted} == expected
    assert len(verdicts) == len(FILES)
    processed = spark.read.parquet(f"{out}/processed")
    assert {name_of(r.source_file) for r in processed.select("source_file").collect()} == expected - {"header_only"}
    counts = health.file_counts(intake_verdicts(spark, landing, out)).first()
    assert (counts.accepted_files, counts.rejected_files) == (len(expected), len(FILES) - len(expected))


def test_an_empty_file_beside_good_ones_is_an_error(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "good.csv").write_text(f"{HEAD}\n{GOOD}\n")
    assert daily.strict_labs(spark, str(tmp_path), DAY).count() == 1
    (tmp_path / "a" / "b" / "empty.csv").write_text("")
    with pytest.raises(daily.InvalidLabFile, match="empty_file"):
        daily.strict_labs(spark, str(tmp_path), DAY)


def test_inventory_names_every_file(spark, landing):
    assert sorted(name_of(r.source_file) for r in inventory(spark, landing).collect()) == sorted(name_of(n) for n in FILES)


cells = st.text(st.sampled_from('a",\n x'), max_size=8)


@given(st.lists(st.lists(cells, min_size=5, max_size=5), min_size=1, max_size=12), st.integers(20, 90))
@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
def test_records_over_lines_equal_a_plain_reader(spark, tmp_path_factory, table, block):
    """Any text in the fields, lines of a file cut into many blocks."""
    folder = tmp_path_factory.mktemp("breaks")
    with open(folder / "x.csv", "w", newline="") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerow(HEAD.split(","))
        writer.writerows(table)
    side = spark.newSession()
    side.conf.set("spark.sql.files.maxPartitionBytes", block)
    side.conf.set("spark.sql.files.openCostInBytes", 0)
    lines = read_lab_lines(side, str(folder))
    heads = headers(lines)
    got = lab_rows(lines, heads).where("NOT header_line").select(*HEAD.split(",")).collect()
    with open(folder / "x.csv", newline="") as file:
        expected = [tuple(row) for row in csv.reader(file)][1:]
    assert sorted(tuple(v or "" for v in r) for r in got) == sorted(expected)


def test_small_blocks_do_not_make_as_many_tasks(spark, tmp_path):
    (tmp_path / "x.csv").write_text(f"{HEAD}\n" + f"{GOOD}\n" * 300_000)
    lines = read_lab_lines(_small_blocks(spark), str(tmp_path))
    assert lines.select("block").distinct().count() > 200
    assert lines.rdd.getNumPartitions() <= 16 * spark.sparkContext.defaultParallelism
    assert headers(lines).first().header == HEAD and lines.count() == 300_001


def test_blocks_meet_once(spark, tmp_path):
    (tmp_path / "x.csv").write_text(f"{HEAD}\n{GOOD}\n")
    plan = with_line_breaks(read_lab_lines(spark, str(tmp_path)))._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join Inner") == 1


@pytest.mark.parametrize(
    "line, from_out, from_in",
    [("a,b", False, True), ('a,"b', True, False), ('a"', False, False), ('"a""b"', False, False), ('x"",y', False, True), ('5" pipe,"', True, True), ("", False, True)],
)
def test_lines_map_the_state_of_quotes(line, from_out, from_in):
    """Java's possessive patterns mean the same in Python."""
    assert (re.search(WHOLE_LINE, line) is None, re.search(CLOSING_LINE, line) is None) == (from_out, from_in)


def raw_labs(spark, *rows):
    return spark.createDataFrame([("P001", "WBC", *r, "2026-01-05") for r in rows], RAW_LAB)


def test_nan_result_is_valid_and_not_abnormal(spark):
    rows = raw_labs(spark, ("nan", "4-11"), ("12", "4-11"), ("3.9", "4-11"), ("11", "4-11"))
    assert lab.typed_labs(rows).where(lab.lab_row_error().isNotNull()).isEmpty()
    assert [r.is_abnormal for r in lab.normalize_labs(rows).collect()] == [False, True, True, False]


def typed_labs(spark, rows):
    return spark.createDataFrame([(p, "WBC", float(v), "4-11", 4.0, 11.0, utc(2026, 1, 5), v > 11) for p, v in rows], LAB)


def test_every_patient_day_keeps_all_results_in_lists(spark):
    """One patient-day holds most rows: one rule splits it like the others, and nothing is lost."""
    rows = [("HOT", i % 50) for i in range(500)] + [("P1", 3), ("P1", 12)]
    labs = typed_labs(spark, rows)
    lists = summarize_labs(labs, page_rows=10).collect()
    hot = [r for r in lists if r.patient_id == "HOT"]
    assert len(hot) == 5 and {(r.result_count, r.abnormal_count) for r in hot} == {(500, 380)}
    assert sorted((t.result_value, t.times) for r in hot for t in r.tests) == [(float(i), 10) for i in range(50)]
    one = [r for r in summarize_labs(labs).collect() if r.patient_id == "HOT"]
    assert [(t.result_value, t.times) for t in one[0].tests] == [(float(i), 10) for i in range(50)] and len(one) == 1
    assert [[t.result_value for t in r.tests] for r in lists if r.patient_id == "P1"] == [[3.0, 12.0]]
    pages = lab_test_pages(labs, page_rows=10).collect()
    hot = [r for r in pages if r.patient_id == "HOT"]
    assert sum(r.times for r in hot) == 500 and len(hot) == 50 and {r.page for r in hot} == set(range(5))
    assert {r.page for r in pages if r.patient_id == "P1"} == {0}


def readings(spark, *rows):
    base = dict(event_id="e", patient_id="P001", heart_rate=70.0, spo2=98.0, systolic_bp=120.0, diastolic_bp=78.0,
                temperature=36.7, timestamp=utc(2026, 1, 5, 10))
    return spark.createDataFrame([[{**base, **r}[n] for n in READING.names] for r in rows], READING)


def test_daily_vitals(spark):
    rows = readings(
        spark, {}, {"heart_rate": 130.0}, {"heart_rate": None, "spo2": float("nan")},
        {"timestamp": utc(2026, 1, 6)},
        {"patient_id": "P2", **dict.fromkeys(["heart_rate", "spo2", "systolic_bp", "diastolic_bp"]), "temperature": float("inf")},
    )
    days = {(r.patient_id, r.report_date): r for r in daily_vitals(rows).collect()}
    assert set(days) == {("P001", DAY), ("P001", date(2026, 1, 6))}
    row = days[("P001", DAY)]
    assert (row.event_count, row.avg_hr, row.min_hr, row.max_hr, row.avg_spo2) == (3, 100.0, 70.0, 130.0, 98.0)


def test_report_joins_both_sides_and_orders(spark):
    vitals = daily_vitals(readings(spark, {"patient_id": "P002", "heart_rate": 130.0}))
    reports = nest_summaries(build_reports(vitals, lab_counts(typed_labs(spark, [("P001", 12), ("P001", 5)]))))
    got = {r.patient_id: r for r in as_json(reports).collect()}
    assert got["P001"].vitals_summary == "{}"
    assert got["P001"].lab_summary == '{"result_count":2,"abnormal_count":1}'
    assert got["P002"].lab_summary == '{"result_count":0,"abnormal_count":0}'
    assert '"avg_hr":130.0' in got["P002"].vitals_summary and '"event_count":1' in got["P002"].vitals_summary
    assert float(got["P001"].risk_score) == 15.0 and got["P002"].risk_flag == "LOW"
    assert [r.patient_id for r in daily_report(reports, DAY).collect()] == ["P001", "P002"]
    assert daily_report(reports, DAY, "HIGH").isEmpty() and daily_report(reports, date(2026, 2, 1)).isEmpty()
    with pytest.raises(ValueError):
        daily_report(reports, DAY, "SEVERE")


def test_report_day_can_run_again(spark, tmp_path):
    write_by_date(archive_rows(readings(spark, {"heart_rate": 130.0}, {"patient_id": "P002", "event_id": "e2"})), str(tmp_path / "archive"))
    (tmp_path / "labs").mkdir()
    (tmp_path / "labs" / f"labs_{DAY}.csv").write_text(f"{HEAD}\n{GOOD}\n")
    table = report_table(spark, str(tmp_path / "report"))
    assert table.current().isEmpty() and table.last_version() is None
    for version in (1, 2):
        daily.report_day(spark, str(tmp_path / "archive"), str(tmp_path / "labs"), DAY, table, version)
    rows = table.current().orderBy("patient_id").collect()
    assert [(r.patient_id, float(r.risk_score), r.risk_flag) for r in rows] == [("P001", 15.0, "LOW"), ("P002", 0.0, "LOW")]
    assert table.last_version() == 2 and rows[0].generated_at is not None
    table.compact(2)
    assert table.current().count() == 2
    plan = table.current().where(F.col("report_date") == F.lit(DAY))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan


def test_stored_report_keeps_every_result(spark, tmp_path):
    labs = typed_labs(spark, [("P001", i % 40) for i in range(400)] + [("P002", 5)])
    table = report_table(spark, str(tmp_path / "report"))
    for version in (1, 2):
        daily.store_run(readings(spark, {}), labs, DAY, DAY, table, version)
    found = daily.stored_results(spark, table).groupBy("patient_id").agg(F.sum("times").alias("n"), F.count("*").alias("kinds"))
    assert sorted(map(tuple, found.collect())) == [("P001", 400, 40), ("P002", 1, 1)]
    stored = table.current().where("patient_id = 'P001'").first()
    assert json.loads(stored.lab_summary).keys() == {"result_count", "abnormal_count"}
    assert json.loads(stored.lab_summary)["result_count"] == 400


def test_counts_of_results_counted_by_day(spark):
    labs = typed_labs(spark, [("P001", 12), ("P001", 12), ("P001", 5), ("P002", 5)])
    labs = labs.unionByName(labs.withColumns({"is_abnormal": F.lit(None).cast("boolean"), "patient_id": F.lit(None).cast("string")}))
    assert sorted(map(tuple, lab_counts(lab_results_by_day(labs)).collect()), key=str) == sorted(map(tuple, lab_counts(labs).collect()), key=str)


def test_a_stored_run_counts_its_stored_results(spark, tmp_path, monkeypatch):
    read = []
    monkeypatch.setattr(daily, "lab_counts", lambda labs: read.extend(labs.inputFiles()) or lab_counts(labs))
    daily.store_run(readings(spark, {}), typed_labs(spark, [("P001", 12)]), DAY, DAY, report_table(spark, str(tmp_path / "report")), 1)
    assert read and all("/results/run_version=1/" in name for name in read)


def test_run_status(spark, tmp_path):
    clock = SimClock(real_start=utc(2026, 9, 30), sim_start=date(2026, 1, 1))
    at = lambda minute, hour=0: datetime(2026, 9, 30, hour, minute, tzinfo=timezone.utc)
    (tmp_path / "labs_2026-01-02.csv").write_text(HEAD)
    assert daily.run_status(spark, at(6), str(tmp_path), clock) == (date(2026, 1, 2), "ready")
    assert daily.run_status(spark, at(11), str(tmp_path), clock) == (date(2026, 1, 3), "waiting")
    assert daily.run_status(spark, utc(2026, 9, 29), str(tmp_path), clock).status == "skipped"


def test_replace_day_leaves_other_days(spark, tmp_path):
    rows = spark.createDataFrame([("P1", date(2026, 1, 1), 1), ("P1", date(2026, 1, 2), 2)], "patient_id string, report_date date, x int")
    write_by_date(rows, str(tmp_path / "t"), "report_date")
    replace_day(rows.limit(0), str(tmp_path / "t"), date(2026, 1, 1))
    assert [r.x for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [2]


def test_patients_need_three_columns(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("patient_id,ward,admit_date,extra\nP1,A,2026-01-01,x\n")
    bad.write_text("id,ward,when\nP1,A,2026-01-01\n")
    table = patient_table(spark, str(tmp_path / "patients"))
    for version in (1, 2):
        table.write_changes(read_patients(spark, str(good)), version)
    assert [tuple(r) for r in table.current().collect()] == [("P1", "A", date(2026, 1, 1))]
    with pytest.raises(ValueError):
        read_patients(spark, str(bad))


def test_violations_are_counted(spark):
    rows = spark.createDataFrame([("P1", 101.0, "LOW"), ("P2", 5.0, "SEVERE"), ("P3", None, None)], "patient_id string, risk_score double, risk_flag string")
    got = {r.rule: r.violations for r in quality.check_violations("daily_risk_report", rows).collect()}
    assert got == {"score_in_0_100": 1, "known_risk_flag": 1}
    nulls = {r.rule: r.violations for r in quality.null_violations("daily_risk_report", rows).collect()}
    absent = dict.fromkeys(["report_date", "vitals_summary", "lab_summary", "generated_at"], 3)
    assert nulls == {"patient_id": 0, "risk_score": 1, "risk_flag": 1} | absent


def test_archive_schema_is_fixed(spark):
    assert archive_rows(readings(spark, {})).schema.names == ARCHIVE.names


def test_report_counts_an_event_once_whatever_the_archive_holds(spark, tmp_path):
    """Copies of a late event, and a file of another format beside the Parquet ones."""
    rows = archive_rows(readings(spark, {"heart_rate": 100.0}))
    write_by_date(rows.union(rows).union(rows), str(tmp_path / "archive"))
    folder = tmp_path / "archive" / f"date={DAY}"
    typed = spark.read.parquet(str(folder)).drop("event_id").dropDuplicates()
    line = typed.selectExpr("'other' AS event_id", "*").toJSON().first().replace("100.0", "120.0")
    (folder / "more.jsonl").write_text(line + "\n")
    (tmp_path / "labs").mkdir()
    (tmp_path / "labs" / f"labs_{DAY}.csv").write_text(f"{HEAD}\n{GOOD}\n")
    table = report_table(spark, str(tmp_path / "report"))
    daily.report_day(spark, str(tmp_path / "archive"), str(tmp_path / "labs"), DAY, table, 1)
    summary = json.loads(table.current().where("patient_id = 'P001'").first().vitals_summary)
    assert summary["event_count"] == 2 and summary["avg_hr"] == 110.0
    # A retried compaction leaves the finished base alone.
    table.compact(1)
    table.compact(1)
    assert table.current().count() == 1
