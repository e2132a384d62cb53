from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsetide.operators.episodes import alert_episodes, closed_by, newly_opened, oldest_open
from pulsetide.operators.serving import UnknownPatient, last_data_received, patient_alerts, ward_snapshot
from pulsetide.params import ALERT_TYPES
from pulsetide.schemas import PATIENT, WINDOW
from pulsetide.sinks.tables import alert_table, live_table
from pulsetide.streaming.reconcile import changed_episodes, fold_from, reconcile_alerts
from tests.conftest import utc
import datetime as dt
import pytest

T0 = utc(2026, 3, 1)
T, FV = "TACHYCARDIA", "FEVER"


def window(index, flags, patient="P1"):
    start = T0 + timedelta(minutes=5 * index)
    values = {"patient_id": patient, "window_start": start, "window_end": start + timedelta(minutes=5),
              "avg_hr": 130.0, "event_count": 5, "anomaly_flags": list(flags)}
    return [values.get(n) for n in WINDOW.names]


def windows(spark, *rows):
    return spark.createDataFrame([window(*r) for r in rows], WINDOW)


def index_of(time):
    return None if time is None else int((time.replace(tzinfo=dt.timezone.utc) - T0).total_seconds() // 300)


def episodes(frame):
    """(patient, type, index of the opening window, index of the closing window's end)"""
    ntz = frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("triggered_at", "resolved_at")})
    return sorted(
        ((r.patient_id, r.alert_type, index_of(r.triggered_at), index_of(r.resolved_at)) for r in ntz.collect()), key=str
    )


def fold(rows):
    """Row-by-row lifecycle in event time."""
    opened, done = {}, []
    for index, flags, patient in sorted(rows, key=lambda r: (r[2], r[0])):
        for kind in ALERT_TYPES:
            key = (patient, kind)
            if kind in flags:
                opened.setdefault(key, index)
            elif key in opened:
                done.append((*key, opened.pop(key), index + 1))
    return sorted([*done, *[(*k, i, None) for k, i in opened.items()]], key=str)


def test_lifecycle(spark):
    assert episodes(alert_episodes(windows(spark, (0, [T]), (1, [T])))) == [("P1", T, 0, None)]
    assert episodes(alert_episodes(windows(spark, (0, [T]), (1, [T, FV])))) == [("P1", FV, 1, None), ("P1", T, 0, None)]
    assert episodes(alert_episodes(windows(spark, (0, [T, FV]), (1, [])))) == [("P1", FV, 0, 2), ("P1", T, 0, 2)]
    assert episodes(alert_episodes(windows(spark, (0, [T]), (1, []), (2, [T])))) == [("P1", T, 0, 2), ("P1", T, 2, None)]
    assert episodes(alert_episodes(windows(spark, (5, [T]), (1, [])))) == [("P1", T, 5, None)]
    assert episodes(alert_episodes(windows(spark, (0, [T]), (9, [])))) == [("P1", T, 0, 10)]


def test_ids_are_stable(spark):
    row = alert_episodes(windows(spark, (0, [T]))).first()
    assert row.alert_id == "P1:TACHYCARDIA:2026-03-01T00:00:00+00:00"


flag_sets = st.sets(st.sampled_from(ALERT_TYPES))
histories = st.dictionaries(
    st.tuples(st.integers(0, 12), st.sampled_from(["P1", "P2"])), flag_sets, min_size=1, max_size=20
).map(lambda d: [(i, sorted(flags), p) for (i, p), flags in d.items()])
quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@given(histories)
@quick
def test_episodes_equal_the_fold(spark, history):
    got = episodes(alert_episodes(windows(spark, *history)))
    assert got == fold(history)
    assert all(end is None or end > start for _, _, start, end in got)
    still_open = [(p, k) for p, k, _, end in got if end is None]
    assert len(still_open) == len(set(still_open))


def test_hot_patient_with_many_windows(spark):
    """Two thirds of all windows belong to one patient."""
    rows = [(i, [T] if i % 7 < 3 else [], "HOT") for i in range(600)] + [(i, [FV] if i % 2 else [], f"P{i % 9}") for i in range(300)]
    assert episodes(alert_episodes(windows(spark, *rows))) == fold(rows)


sparse = st.dictionaries(
    st.tuples(st.integers(0, 40), st.sampled_from(["P1", "P2"])), flag_sets, min_size=1, max_size=30
).map(lambda d: [(i * 71, sorted(flags), p) for (i, p), flags in d.items()])


@given(sparse)
@quick
def test_episodes_over_days_equal_the_fold(spark, history):
    """Windows six hours apart: days of several windows, of one, and of none."""
    assert episodes(alert_episodes(windows(spark, *history))) == fold(history)


def test_a_window_without_flags_is_clear(spark):
    rows = windows(spark, (0, [T]), (300, [T])).unionByName(windows(spark, (600, [])).withColumn("anomaly_flags", F.lit(None).cast("array<string>")))
    assert episodes(alert_episodes(rows)) == [("P1", T, 0, 601)]


@given(histories, histories)
@quick
def test_closing_equals_a_search(spark, history, later):
    opened = [(p, k, i) for p, k, i, end in fold(history) if end is None]
    expected = []
    for p, k, i in opened:
        ends = [j + 1 for j, flags, q in later if q == p and j >= i and k not in flags]
        expected += [(p, k, i, min(ends))] if ends else []
    got = closed_by(windows(spark, *later), alert_episodes(windows(spark, *history)))
    assert episodes(got) == sorted(expected, key=str)


def test_closing_sorts_alerts_and_windows_once(spark):
    """As many rows are sorted as there are alerts and windows, never their product."""
    later = windows(spark, *[(i, [T] if i % 2 else []) for i in range(50)])
    plan = closed_by(later, alert_episodes(windows(spark, (0, [T, FV]))))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" in plan


class Store:
    def __init__(self, spark, path):
        self.spark = spark
        self.live, self.alerts = live_table(spark, f"{path}/live"), alert_table(spark, f"{path}/alerts")

    def batch(self, version, *rows):
        self.live.write_changes(windows(self.spark, *rows), version)
        self.alerts.write_changes(reconcile_alerts(self.live, self.alerts, version), version)
        return episodes(self.alerts.current())


def test_reconcile_late_and_reemitted_windows(spark, tmp_path):
    store = Store(spark, tmp_path)
    assert store.batch(0, (5, [T])) == [("P1", T, 5, None)]
    # A late window before the opening one cannot close it, adjacent or not.
    assert store.batch(1, (1, [])) == [("P1", T, 5, None)]
    assert store.batch(2, (4, [])) == [("P1", T, 5, None)]
    assert store.batch(3, (6, [])) == [("P1", T, 5, 7)]
    # The closed episode's window comes again: no second episode.
    assert store.batch(4, (5, [T])) == [("P1", T, 5, 7)]
    # A correction moves the opening, and then removes the episode.
    assert store.batch(5, (4, [T])) == [("P1", T, 4, 7)]
    assert store.batch(6, (4, []), (5, [])) == []


def test_reconcile_retry_leaves_no_trace(spark, tmp_path):
    store = Store(spark, tmp_path)
    store.batch(0, (0, [T]))
    once = store.batch(1, (1, []), (2, [T]))
    assert store.batch(1, (1, []), (2, [T])) == once == [("P1", T, 0, 2), ("P1", T, 2, None)]


@given(st.lists(histories, min_size=1, max_size=4))
@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
def test_reconcile_equals_the_fold_of_latest_windows(spark, tmp_path_factory, batches):
    store = Store(spark, tmp_path_factory.mktemp("store"))
    latest = {}
    for version, rows in enumerate(batches):
        latest.update({(p, i): (i, flags, p) for i, flags, p in rows})
        assert store.batch(version, *rows) == fold(latest.values())


def test_reconcile_reads_touched_patients_and_days_only(spark, tmp_path):
    """An alert has been open for ten days: its old windows are not read again, nor other patients grouped."""
    store, late = Store(spark, tmp_path), 10 * 288
    store.batch(0, (0, [T]), (0, [FV], "P2"))
    store.batch(1, (late, [T]), (late, [], "P2"))
    store.live.write_changes(windows(spark, (late + 1, [])), 2)
    recent, known = changed_episodes(store.live, store.alerts, 2)
    assert [index_of(r.t) for r in recent.select(F.col("window_start").cast("timestamp_ntz").alias("t")).collect()] == [late + 1]
    assert episodes(known) == [("P1", T, 0, None)]
    for frame in (recent, known):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Aggregate [patient_id") < plan.index("LeftSemi")
    assert "PartitionFilters: [isnotnull(window_date" in recent._jdf.queryExecution().executedPlan().toString()
    assert store.batch(2, (late + 1, [])) == [("P1", T, 0, late + 2), ("P2", FV, 0, late + 1)]


def test_fold_takes_up_what_is_carried(spark):
    carried = spark.createDataFrame([("P1", FV, T0), ("P1", T, T0), ("P2", T, T0)], "patient_id string, alert_type string, triggered_at timestamp")
    found = fold_from(windows(spark, (300, [T]), (301, [FV, "NO_TYPE"]), (310, [], "P3")), carried)
    assert episodes(found) == [("P1", FV, 0, 301), ("P1", FV, 301, None), ("P1", T, 0, 302), ("P2", T, 0, None)]
    # A window is one row, not one per type, until its flags change.
    assert "explode(array(" not in found._jdf.queryExecution().analyzed().toString()


def test_reconcile_survives_compaction(spark, tmp_path):
    store = Store(spark, tmp_path)
    store.batch(0, (0, [T]))
    store.batch(1, (1, [T]))
    store.live.compact(1)
    store.alerts.compact(1)
    assert store.batch(2, (2, [])) == [("P1", T, 0, 3)]
    store.live.compact(2)
    store.alerts.compact(2)
    store.live.vacuum()
    store.alerts.vacuum()
    assert not list((tmp_path / "live" / "changes").glob("version=[01]"))
    assert (tmp_path / "live" / "base" / "version=1").exists()
    assert store.batch(3, (3, [T])) == [("P1", T, 0, 3), ("P1", T, 3, None)]
    assert store.live.last_version() == 3


def test_open_and_close_by_a_window(spark):
    history = alert_episodes(windows(spark, (0, [T])))
    assert newly_opened(windows(spark, (1, [T])), history).isEmpty()
    assert [r.alert_type for r in newly_opened(windows(spark, (1, [T, FV])), history).collect()] == [FV]
    assert closed_by(windows(spark, (1, [T])), history).isEmpty()
    assert episodes(closed_by(windows(spark, (1, []), (2, [])), history)) == [("P1", T, 0, 2)]
    assert [r.alert_type for r in oldest_open(history).collect()] == [T]


def test_snapshot_and_alert_questions(spark):
    rows = windows(spark, (0, [T]), (1, []), (2, [T]), (0, [], "P2"), (0, [], "P9"))
    history = alert_episodes(rows)
    patients = spark.createDataFrame([("P1", "A", None), ("P2", "B", None)], PATIENT)
    snapshot = {r.patient_id: (r.ward, r.active_alert, r.anomaly_flags) for r in ward_snapshot(rows, history, patients).collect()}
    assert snapshot == {"P1": ("A", True, [T]), "P2": ("B", False, [])}
    assert [r.patient_id for r in ward_snapshot(rows, history, patients, "B").collect()] == ["P2"]
    assert [index_of(r.t) for r in patient_alerts(history, patients, "P1", "all").select(F.col("triggered_at").cast("timestamp_ntz").alias("t")).collect()] == [2, 0]
    assert patient_alerts(history, patients, "P1", "active").count() == 1
    assert patient_alerts(history, patients, "P1", "resolved").count() == 1
    assert patient_alerts(history, patients, "P2").isEmpty()
    with pytest.raises(UnknownPatient):
        patient_alerts(history, patients, "P9")
    with pytest.raises(ValueError):
        patient_alerts(history, patients, "P1", "closed")
    assert index_of(last_data_received(rows).select(F.col("last_data_received").cast("timestamp_ntz")).first()[0]) == 3
