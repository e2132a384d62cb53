import json
import os
from datetime import timedelta

from pyspark.sql import functions as F

from checks.queries import plain
from pulsetide.operators.clean import clean_readings, dedupe_readings
from pulsetide.operators.episodes import alert_episodes
from pulsetide.plans.file_run import windows_of
from pulsetide.schemas import RAW_READING
from pulsetide.sinks.tables import alert_table, live_table
from pulsetide.sources.readings import decode_readings
from pulsetide.streaming import alert_state, speed
from pulsetide.streaming.progress import ProgressLog, progress_rows
from tests.conftest import rows_of, utc

T0 = utc(2026, 1, 1, 12)


def event(event_id, minute, patient="P1", **vitals):
    values = {"event_id": event_id, "patient_id": patient, "heart_rate": 80.0, **vitals}
    return {**values, "timestamp": (T0 + timedelta(minutes=minute)).isoformat()}


def land(folder, name, rows):
    """The file source takes files by modification time, so each gets its own second."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{name}.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    os.utime(path, (1_700_000_000 + int(name),) * 2)


def source(spark, folder):
    """One file per micro-batch, oldest first."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))
    return decode_readings(lines)


def batch(spark, folder):
    return decode_readings(spark.read.text(str(folder)))


def run(query):
    query.awaitTermination()
    return query


def same(a, b):
    assert sorted(rows_of(plain(a)), key=repr) == sorted(rows_of(plain(b)), key=repr)


IN_ORDER = [
    [event("a", 0), event("b", 1, heart_rate=130.0), event("b", 1, heart_rate=130.0), event("x", 1, spo2=10)],
    [event("c", 6), event("b", 1, heart_rate=130.0), event("d", 7, "P2", spo2=85)],
    [event("e", 12, heart_rate=140.0), event("f", 13, "P2")],
]


def start_live(spark, folder, tmp_path):
    live, alerts = live_table(spark, f"{tmp_path}/live"), alert_table(spark, f"{tmp_path}/alerts")
    query = speed.start_live(source(spark, folder), live, alerts, f"{tmp_path}/cp-live", available_now=True, compact_every=2)
    return run(query), live, alerts


def test_stream_equals_batch_when_nothing_is_late(spark, tmp_path):
    folder = tmp_path / "in"
    for i, rows in enumerate(IN_ORDER):
        land(folder, str(i), rows)
    _, live, alerts = start_live(spark, folder, tmp_path)
    expected = windows_of(batch(spark, folder))
    same(live.current(), expected)
    same(alerts.current(), alert_episodes(expected))

    run(speed.start_archive(source(spark, folder), f"{tmp_path}/archive", f"{tmp_path}/cp-archive", available_now=True))
    archived = spark.read.parquet(f"{tmp_path}/archive")
    assert {"date", "ingested_at"} <= set(archived.columns)
    same(archived.select(*RAW_READING.names), dedupe_readings(clean_readings(batch(spark, folder))))


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    folder = tmp_path / "in"
    for i, rows in enumerate(IN_ORDER):
        land(folder, str(i), rows)
        _, live, alerts = start_live(spark, folder, tmp_path)
    same(live.current(), windows_of(batch(spark, folder)))
    same(alerts.current(), alert_episodes(windows_of(batch(spark, folder))))


def test_late_rows_are_dropped_and_copies_leave_the_state(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "0", [event("a", 60)])
    land(folder, "1", [event("b", 61)])
    land(folder, "2", [event("late", 0), event("c", 200)])
    land(folder, "3", [event("d", 201)])
    query, live, _ = start_live(spark, folder, tmp_path)
    assert live.current().count() == 2
    assert live.current().where(F.col("window_start") < F.lit(T0 + timedelta(minutes=55))).isEmpty()
    progress = progress_rows(spark, query)
    assert progress.agg(F.sum("dropped_late")).first()[0] >= 1
    assert progress.agg(F.sum("input_rows")).first()[0] == 5
    last = progress.orderBy(F.desc("batch_id")).first()
    assert last.state_rows <= 4


def test_progress_log_keeps_every_batch(spark, tmp_path):
    folder = tmp_path / "in"
    for i, rows in enumerate(IN_ORDER):
        land(folder, str(i), rows)
    log = ProgressLog(spark, f"{tmp_path}/log")
    spark.streams.addListener(log)
    try:
        query = run(speed.start_archive(source(spark, folder), f"{tmp_path}/archive", f"{tmp_path}/cp", available_now=True))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(log)
    same(log.rows().select("batch_id", "input_rows"), progress_rows(spark, query).select("batch_id", "input_rows"))
    assert log.rows().agg(F.sum("input_rows")).first()[0] == sum(map(len, IN_ORDER))


def test_archive_can_keep_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "0", [event("a", 600)])
    land(folder, "1", [event("b", 601), event("a", 600)])
    land(folder, "2", [event("late", 0)])
    run(speed.start_archive(source(spark, folder), f"{tmp_path}/all", f"{tmp_path}/cp", available_now=True, archive_late=True))
    archived = spark.read.parquet(f"{tmp_path}/all")
    assert archived.count() == 4
    assert dedupe_readings(archived).count() == 3


def test_alert_state_gets_numbers_and_text(spark, tmp_path):
    land(tmp_path / "in", "0", [event("a", 0)])
    changes = alert_state.alert_changes(speed.stream_windows(source(spark, tmp_path / "in")))
    plan = changes._jdf.queryExecution().analyzed().toString()
    assert changes.schema == alert_state.CHANGE
    assert "unix_micros" in plan and "array_join" in plan


def test_alert_state_follows_closed_windows(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "0", [event("a", 0, heart_rate=130.0), event("b", 6, heart_rate=130.0), event("z", 6, "P2", spo2=80)])
    land(folder, "1", [event("c", 11), event("d", 16, heart_rate=130.0), event("y", 12, "P2", spo2=80, heart_rate=125.0)])
    land(folder, "2", [event("e", 100, "P3")])
    land(folder, "3", [event("f", 101, "P3")])
    changes = alert_state.alert_changes(speed.stream_windows(source(spark, folder)))
    writer = changes.writeStream.format("parquet").outputMode("append").option("path", f"{tmp_path}/out")
    run(writer.option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
    got = alert_state.episodes_from_changes(spark.read.schema(alert_state.CHANGE).parquet(f"{tmp_path}/out"))
    closed = windows_of(batch(spark, folder)).where("patient_id <> 'P3'")
    same(got, alert_episodes(closed))


def test_intake_splits_once(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "0", [event("a", 0), event("b", 0, None), {"event_id": "c", "patient_id": "P1", "timestamp": "2026-01-01"}])
    seen = {"ok": [], "bad": []}

    def accept(checked, _):
        seen["ok"] += rows_of(checked.where("invalid_detail IS NULL").select("event_id"))

    def reject(checked, _):
        seen["bad"] += rows_of(checked.where("invalid_detail IS NOT NULL").select("event_id", "invalid_detail"))

    run(speed.start_intake(source(spark, folder), accept, reject, f"{tmp_path}/cp", available_now=True))
    assert seen == {"ok": [("a",)], "bad": [("b", "missing_patient"), ("c", "no_vitals")]}


def test_run_until_any_ends(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "0", IN_ORDER[0])
    ends = speed.start_archive(source(spark, folder), f"{tmp_path}/a", f"{tmp_path}/cp-a", available_now=True)
    goes_on = speed.start_archive(source(spark, folder), f"{tmp_path}/b", f"{tmp_path}/cp-b")
    spark.streams.resetTerminated()
    speed.run_until_any_ends(spark, [ends, goes_on])
    assert not ends.isActive and not goes_on.isActive
