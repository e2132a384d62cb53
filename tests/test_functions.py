from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pulsetide.functions import clock, parsing, risk
from pulsetide.functions.rounding import round_half_even, steady_mean
from pulsetide.operators.summaries import score_patients
from pulsetide.params import AlertLimits, RiskRules, SimClock, load_params, params_from
from tests.conftest import utc


def column(spark, values, kind, expr):
    frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in frame.selectExpr(expr("v")).collect()]


def test_numbers(spark):
    texts = ["80", " 7 ", "1e3", "inf", "-5.", "1f", "2.0d", "3F ", "4D\t", "1_000", "", "x", None]
    got = column(spark, texts, "string", parsing.to_number)
    assert got == [80.0, 7.0, 1000.0, float("inf"), -5.0, None, None, None, None, None, None, None, None]


def test_instants(spark):
    texts = [
        "2026-01-01T12:03:00Z", "2026-01-01T12:03:00+05:30", "2026-01-01 12:03:00.25", "2026-01-01",
        "2026", "not-a-date", "2026-13-01", "", None,
    ]
    got = column(spark, texts, "string", lambda c: f"CAST({parsing.to_instant(c)} AS TIMESTAMP_NTZ)")
    assert got[:4] == [
        datetime(2026, 1, 1, 12, 3), datetime(2026, 1, 1, 6, 33),
        datetime(2026, 1, 1, 12, 3, 0, 250000), datetime(2026, 1, 1),
    ]
    assert got[4:] == [None] * 5


@pytest.mark.parametrize(
    "text, low, high",
    [("4.0-11.0", 4.0, 11.0), (" 70 - 100 ", 70.0, 100.0), ("-2--1", -2.0, -1.0), ("bad", None, None), ("4-", None, None)],
)
def test_reference_range(spark, text, low, high):
    frame = spark.createDataFrame([(text,)], "v string")
    row = frame.selectExpr(parsing.reference_low("v"), parsing.reference_high("v")).first()
    assert tuple(row) == (low, high)


def test_rounding_equals_python(spark):
    values = [36.6175, 0.0005, 0.0015, 2.5, -36.6175, 70.0005, 83.6725, 1e17, 0.0, 119.9995, 120.0004]
    values += [k * 0.0005 for k in range(-3000, 3000)]
    for digits in (2, 3):
        got = column(spark, values, "double", lambda c: round_half_even(c, digits))
        assert got == [round(v, digits) for v in values]


def test_steady_mean_does_not_depend_on_order(spark):
    values = [83.205, 83.1975, 84.615, 1e-10, 36.1, 36.7]
    means = set()
    for turn in range(len(values)):
        rows = [(v,) for v in values[turn:] + values[:turn]]
        means.add(spark.createDataFrame(rows, "v double").repartition(3).agg(F.expr(steady_mean("v"))).first()[0])
    assert len(means) == 1
    huge = spark.createDataFrame([(1e300,), (3e300,), (None,)], "v double").agg(F.expr(steady_mean("v"))).first()[0]
    assert huge == 2e300


def score(spark, vitals, labs, trend=None):
    names = ["avg_hr", "avg_spo2", "avg_temp", "avg_systolic_bp"]
    row = [vitals.get(n) for n in names] + [labs.get("result_count"), labs.get("abnormal_count"), trend]
    schema = ", ".join(f"{n} double" for n in names) + ", result_count long, abnormal_count long, trend_direction string"
    r = score_patients(spark.createDataFrame([row], schema)).first()
    return r.risk_score, r.risk_flag


def test_scores(spark):
    normal = {"avg_hr": 75.0, "avg_spo2": 97.0, "avg_temp": 37.0, "avg_systolic_bp": 120.0}
    assert score(spark, normal, {"result_count": 2, "abnormal_count": 0}) == (0.0, "LOW")
    assert score(spark, {"avg_hr": 121.0}, {"result_count": 1, "abnormal_count": 1}) == (90.0, "HIGH")
    assert score(spark, {}, {}) == (0.0, "LOW")
    assert score(spark, {"avg_hr": 121.0}, {"result_count": 1, "abnormal_count": 1}, "Worsening") == (100.0, "HIGH")
    assert score(spark, {}, {}, "mixed") == (5.0, "LOW")
    assert score(spark, {"avg_hr": 121.0, "avg_spo2": 97.0}, {}) == (30.0, "MEDIUM")


def test_limits_are_strict(spark):
    frame = spark.createDataFrame([(120.0, 90.0, 38.5, 90.0)], "avg_hr double, avg_spo2 double, avg_temp double, avg_systolic_bp double")
    assert frame.selectExpr(risk.vital_burden(AlertLimits())).first()[0] == 0.0


def test_params(tmp_path):
    path = tmp_path / "limits.yaml"
    path.write_text("vitals:\n  hr_high: 110\n  spo2_low: 92\nrisk:\n  high_score: 80\n")
    params = load_params(str(path))
    assert params.limits == AlertLimits(hr_high=110.0, spo2_low=92.0)
    assert params.risk == RiskRules(high_score=80.0)
    assert params_from({"hr_high": "115"}).limits.hr_high == 115.0


def test_clock(spark):
    settings = SimClock(real_start=utc(2026, 9, 30, 8, 5, 5), sim_start=date(2026, 1, 1), day_seconds=300.0)
    frame = spark.createDataFrame([(utc(2026, 9, 30, 8, 5, 5),), (utc(2026, 9, 30, 8, 10, 4),), (utc(2026, 9, 30, 8, 10, 5),)], "t timestamp")
    days = [r[0] for r in frame.select(clock.sim_date(F.col("t"), settings)).collect()]
    assert days == [date(2026, 1, 1), date(2026, 1, 1), date(2026, 1, 2)]
    window = frame.limit(1).select(
        clock.real_window_start(F.lit(date(2026, 1, 2)), settings).cast("timestamp_ntz"),
        clock.real_window_end(F.lit(date(2026, 1, 2)), settings).cast("timestamp_ntz"),
        clock.current_sim_date(settings),
    ).first()
    assert window[0] == datetime(2026, 9, 30, 8, 10, 5) and window[1] == datetime(2026, 9, 30, 8, 15, 5)
    assert window[2] > date(2026, 1, 1)


def test_offset_without_colon_is_read(spark):
    from pulsetide.functions.parsing import to_instant

    values = [("2026-01-01T12:00:00+0530",), ("2026-01-01T12:00:00+05:30",), ("2026-01-01T06:30:00Z",), ("2026-01-01",)]
    rows = spark.createDataFrame(values, "t string").selectExpr(f"{to_instant('t')} AS t").collect()
    assert rows[0] == rows[1] == rows[2] and rows[3].t is not None


def test_basic_forms_and_other_separators(spark):
    from pulsetide.functions.parsing import to_instant

    same = ["20270101T003000Z", "20270101 0030", "2027-01-01t00:30:00.0Z", "2027-01-01_02:30+02", "20270101T063000,000000+0600", "20270101T003000.0000001"]
    bad = ["2027010", "20271301T003000Z", "2027-01-01T", "20270101T25", "2027-01-0100:30", "270101T003000Z"]
    rows = spark.createDataFrame([(t,) for t in same + bad], "t string").selectExpr(f"CAST({to_instant('t')} AS STRING) AS t").collect()
    assert [r.t for r in rows] == ["2027-01-01 00:30:00"] * len(same) + [None] * len(bad)
