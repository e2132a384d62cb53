import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pulsetide.operators.clean import clean_readings, dedupe_readings
from pulsetide.operators.quality import dead_letters, publishable, run_counts, with_validity
from pulsetide.operators.upsert import latest_given
from pulsetide.operators.windows import reading_alerts, window_vitals
from pulsetide.params import ALERT_TYPES, VALID_RANGES, AlertLimits
from pulsetide.plans.file_run import process_json_lines, windows_of
from pulsetide.schemas import RAW_READING, READING
from pulsetide.sinks.outputs import publish_rows
from pulsetide.sources.readings import decode_readings, read_archive_day, read_archive_files, read_json_lines
from tests.conftest import rows_of, utc

# A reading in the middle of every range, half an hour into the year.
MIDDLE = {v: str((lo + hi) / 2) for v, (lo, hi) in VALID_RANGES.items()}
BASE = {"event_id": "ev/00", "patient_id": "bed 9", **MIDDLE, "timestamp": "2027-01-01T00:30:00+00:00"}


def raw(spark, *changes):
    return spark.createDataFrame([[{**BASE, **c}[n] for n in RAW_READING.names] for c in changes], RAW_READING)


def kept(spark, *changes):
    """Which of the changed readings survive cleaning, by their place."""
    named = [{"event_id": str(i), **c} for i, c in enumerate(changes)]
    return sorted(int(r.event_id) for r in clean_readings(raw(spark, *named)).collect() if (r.event_id or "").isdigit())


def test_every_range_holds_its_ends_and_nothing_beyond(spark):
    step, changes, good = 1 / 64, [], []
    for vital, (lo, hi) in VALID_RANGES.items():
        for value, inside in ((lo, True), (hi, True), (lo - step, False), (hi + step, False), ("NaN", False), ("-Infinity", False), (None, True)):
            good += [len(changes)] if inside else []
            changes.append({vital: None if value is None else str(value)})
    assert kept(spark, *changes) == good


def test_identity_and_time_are_required(spark):
    for column in ("patient_id", "timestamp"):
        assert kept(spark, {column: None}, {}, {column: ""}) == [1]
    assert clean_readings(raw(spark, {"event_id": None}, {"event_id": ""})).isEmpty()
    assert kept(spark, {"timestamp": "soon"}, {"timestamp": "2027-13-01"}, {"timestamp": "2027-01-01"}) == [2]


def test_text_becomes_numbers_and_instants(spark):
    spelled = {"spo2": "9.75e1", "temperature": " 37", "timestamp": "2027-01-01T02:00:30.5+0130"}
    row = clean_readings(raw(spark, spelled)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).first()
    assert (row.spo2, row.temperature, row.timestamp) == (97.5, 37.0, datetime(2027, 1, 1, 0, 30, 30, 500_000))
    assert kept(spark, {"spo2": "97 %"}, {"spo2": "97f"}, {"spo2": "0x61"}) == []


def test_of_copies_the_first_to_arrive_stays(spark):
    changes = [{"spo2": str(90 + i), "timestamp": f"2027-01-01T00:{50 - i}:00Z"} for i in range(5)]
    copies = clean_readings(raw(spark, *changes))
    assert [r.spo2 for r in dedupe_readings(copies).collect()] == [94.0]
    assert [r.spo2 for r in dedupe_readings(copies.withColumn("n", 100 - F.col("spo2")), "n").collect()] == [94.0]
    assert [r.spo2 for r in dedupe_readings(copies.withColumn("n", F.col("spo2")), "n").collect()] == [90.0]


def test_a_limit_trips_only_beyond_itself(spark):
    limits = AlertLimits()
    bounds = {"heart_rate": (limits.hr_high, 1), "spo2": (limits.spo2_low, -1), "temperature": (limits.temp_high, 1), "systolic_bp": (limits.sbp_low, -1)}
    names = dict(zip(bounds, ALERT_TYPES))
    on, beyond = ({v: str(x + d * e) for v, (x, d) in bounds.items()} for e in (0, 0.25))
    alone = [{"event_id": v, **on, v: beyond[v]} for v in bounds]
    got = {r.event_id: r.alerts for r in reading_alerts(clean_readings(raw(spark, *alone, {"event_id": "on", **on}, {"event_id": "all", **beyond}))).collect()}
    assert got == {**{v: [names[v]] for v in bounds}, "on": [], "all": list(ALERT_TYPES)}


def test_windows_average_what_was_measured(spark):
    """Two windows, a vital that no reading of the first has, and one that half of them have."""
    changes = [
        {"event_id": str(i), "spo2": None, "heart_rate": str(60 + i) if i % 2 else None, "timestamp": f"2027-01-01T00:0{i}:59Z"}
        for i in range(8)
    ]
    rows = window_vitals(clean_readings(raw(spark, *changes))).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    got = [(r.window_start.minute, r.event_count, r.avg_hr, r.min_hr, r.max_hr, r.avg_spo2) for r in rows.orderBy("window_start").collect()]
    assert got == [(0, 5, 62.0, 61.0, 63.0, None), (5, 3, 66.0, 65.0, 67.0, None)]


def test_undecodable_payload_is_a_row_of_nulls(spark):
    lines = spark.createDataFrame([('{"event_id": 7, "heart_rate": "80"}',), ("{oops",)], "value string")
    assert [(r.event_id, r.heart_rate) for r in decode_readings(lines).collect()] == [("7", "80"), (None, None)]


def test_file_mode(spark, tmp_path):
    source = tmp_path / "in.jsonl"
    source.write_text(
        '{"event_id": "a", "patient_id": "P1", "heart_rate": 130, "timestamp": "2026-01-01T12:01:00Z"}\n'
        '{"event_id": "a", "patient_id": "P1", "heart_rate": 80, "timestamp": "2026-01-01T12:00:00Z"}\n'
        "{broken\n"
        '{"event_id": "b", "patient_id": "P1", "heart_rate": 500, "timestamp": "2026-01-01T12:01:00Z"}\n'
    )
    counts = process_json_lines(spark, str(source), str(tmp_path / "out"))
    assert (counts.accepted, counts.rejected) == (1, 2)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert '"window_start":"2026-01-01T12:00:00+00:00"' in text
    assert '"avg_hr":130.0' in text and '"avg_temp":null' in text and '"anomaly_flags":["TACHYCARDIA"]' in text


VALID = {"spo2": None}


@pytest.mark.parametrize(
    "change, reason",
    [
        (VALID, None),
        ({"patient_id": None}, "missing_patient"),
        ({"timestamp": "soon"}, "bad_timestamp"),
        ({"timestamp": None}, "bad_timestamp"),
        ({n: None for n in ("heart_rate", "spo2", "systolic_bp", "diastolic_bp", "temperature")}, "no_vitals"),
    ],
)
def test_structural_validity(spark, change, reason):
    checked = with_validity(raw(spark, change))
    assert checked.first().invalid_detail == reason
    assert publishable(checked).count() == (reason is None)
    letters = dead_letters(checked, READING.names).collect()
    assert len(letters) == (reason is not None)
    if reason:
        assert letters[0].error_reason == "failed_validation" and '"raw_payload":{' in letters[0].value
        assert json.loads(letters[0].value)["raw_payload"].keys() == set(READING.names)
        assert letters[0].key == ("unknown" if reason == "missing_patient" else "bed 9")


def test_published_rows_carry_the_trace(spark):
    row = publish_rows(with_validity(raw(spark, {}))).first()
    assert row.key == "bed 9" and row.headers[0].key == "trace_id" and bytes(row.headers[0].value) == b"ev/00"
    fresh = publish_rows(with_validity(raw(spark, {"event_id": None}))).first()
    assert len(fresh.headers[0].value) == 36


def test_counts_of_a_run(spark):
    row = run_counts(raw(spark, {}, {}, {"event_id": "e-2"}, {"spo2": "7"}, {"event_id": None})).first()
    assert (row.accepted, row.rejected) == (2, 2)
    assert tuple(run_counts(raw(spark, {}).limit(0)).first()) == (0, 0)


def test_archive_formats(spark, tmp_path):
    day = tmp_path / "date=2026-01-05"
    day.mkdir()
    line = '{"event_id": "%s", "patient_id": "P001", "heart_rate": "%s", "timestamp": "2026-01-05T10:00:00Z"}'
    (day / "a.jsonl").write_text("\n".join([line % ("a", 70), line % ("b", 130)]))
    (day / "b.json").write_text(f"[{line % ('c', 80)}, {line % ('d', 90)}]")
    (day / "c.json").write_text(line % ("e", 60))
    rows = clean_readings(raw(spark, {"event_id": "p"})).coalesce(1)
    rows.write.parquet(str(tmp_path / "one"))
    part = next((tmp_path / "one").glob("part-*"))
    (day / "d.parquet").write_bytes(part.read_bytes())
    found = read_archive_day(spark, str(tmp_path), date(2026, 1, 5))
    got = {r.event_id: r.heart_rate for r in found.collect()}
    assert got == {"a": 70.0, "b": 130.0, "c": 80.0, "d": 90.0, "e": 60.0, "p": float(MIDDLE["heart_rate"])}
    assert read_archive_day(spark, str(tmp_path), date(2026, 1, 6)).isEmpty()
    with pytest.raises(ValueError):
        read_archive_files(spark, [str(day / "x.txt")])


def test_windows_of_an_hour_and_a_day(spark):
    readings = raw(spark, {}, {"event_id": "ev/01", "timestamp": "2027-01-01T00:59:59Z"}, {"event_id": "ev/02", "timestamp": "2027-01-01T23:00:00Z"})
    counts = {m: sorted(r.event_count for r in windows_of(readings, m).collect()) for m in (5, 60, 1440)}
    assert counts == {5: [1, 1, 1], 60: [1, 2], 1440: [3]}


def test_timestamps_are_utc(spark):
    row = clean_readings(raw(spark, {"timestamp": "2026-01-01T01:30:00+02:00"})).select(F.col("timestamp").cast("date")).first()
    assert row[0] == date(2025, 12, 31)
    assert rows_of(spark.createDataFrame([(utc(2026, 1, 1),)], "t timestamp").select(F.col("t").cast("string"))) == [("2026-01-01 00:00:00",)]


def test_dead_letters_hold_the_message_as_sent(spark):
    """Numbers as written, fields of no column, texts that are no JSON; what was no message has no payload."""
    sent = [
        '{"event_id": "a", "patient_id": "", "heart_rate": 1.50e1, "ward": {"bed": [1, null]}}',
        '{"event_id": "b", "patient_id": "P1", "timestamp": "soon", "spo2": "97 %"}',
        '{"event_id": "c", "patient_id": "P1", "timest',
        'no "JSON" at all \\ é',
        "",
        None,
    ]
    messages = spark.createDataFrame([(t,) for t in sent], "value string")
    rows = dead_letters(with_validity(decode_readings(messages, keep_text=True)))
    got = {(r.invalid_detail, r.key, r.value) for r in rows.collect()}
    end = ',"error_reason":"failed_validation"}'
    assert got == {
        ("missing_patient", "unknown", '{"raw_payload":' + sent[0] + end),
        ("bad_timestamp", "P1", '{"raw_payload":' + sent[1] + end),
        *[("undecodable", "unknown", '{"raw_payload":' + json.dumps(t, ensure_ascii=False) + end) for t in sent[2:]],
    }
    assert all(json.loads(value)["error_reason"] == "failed_validation" for _, _, value in got)


def test_columns_are_merged_one_by_one(spark):
    rows = spark.createDataFrame(
        [("k", 1, ["a", "b"], 1, "x"), ("k", 2, ["a"], 2, "not given"), ("k", 3, ["b"], 9, None), ("l", 1, [], 5, "y"), ("m", 7, ["a"], None, None)],
        "key string, version int, given array<string>, a int, b string",
    )
    got = sorted(map(tuple, latest_given(rows, ["key"], "version").collect()))
    assert got == [("k", 2, None), ("l", None, None), ("m", None, None)]
    plan = latest_given(rows, ["key"], "version")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_file_mode_reads_its_source_once(spark, tmp_path):
    """The counts are taken on the way: one scan, and the same as those of a pass of its own."""
    lines = [{"event_id": str(i % 7), "patient_id": "P1", "heart_rate": 70 + i, "timestamp": "2026-01-01T10:00:00Z"} for i in range(20)]
    text = "\n".join([*map(json.dumps, lines), "broken", '{"event_id": "x", "patient_id": "P1", "spo2": 10, "timestamp": "2026-01-01T10:00:00Z"}'])
    (tmp_path / "in.jsonl").write_text(text)
    counts = process_json_lines(spark, f"{tmp_path}/in.jsonl", f"{tmp_path}/out")
    assert (counts.accepted, counts.rejected) == (7, 2)
    assert tuple(run_counts(read_json_lines(spark, f"{tmp_path}/in.jsonl")).first()) == (7, 2)
    assert sum(json.loads(line)["event_count"] for part in (tmp_path / "out").glob("*.json") for line in part.read_text().splitlines()) == 7
