import random
from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsetide.operators import health
from tests.conftest import utc

T0 = utc(2026, 1, 1)


def events(spark, seconds, source="a"):
    return spark.createDataFrame([(T0 + timedelta(seconds=s), source) for s in seconds], "timestamp timestamp, source string")


def seconds_of(frame, *names):
    return sorted(tuple(r) for r in frame.select(*[(F.unix_micros(n) / 1e6 - F.lit(T0.timestamp())).alias(n) for n in names]).collect())


times = st.lists(st.integers(0, 400_000), min_size=1, max_size=40)


@given(times)
@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
def test_gaps_equal_brute_force(spark, seconds):
    ordered = sorted(seconds)
    expected = sorted((a, b, a + 90) for a, b in zip(ordered, ordered[1:]) if b - a > 90)
    assert seconds_of(health.stale_gaps(events(spark, seconds)), "gap_start", "gap_end", "fired_at") == expected


def test_gaps_per_source_with_a_hot_one(spark):
    rng = random.Random(3)
    hot = [s for s in range(0, 200_000, 20) if not 50_000 < s < 50_200]
    rows = events(spark, hot, "hot").unionByName(events(spark, sorted(rng.sample(range(200_000), 5)), "cold"))
    found = health.stale_gaps(rows, ["source"])
    assert seconds_of(found.where("source = 'hot'"), "gap_start", "gap_end") == [(50_000, 50_200)]
    assert found.where("source = 'cold'").count() == 4


def test_open_silence_fires(spark):
    as_of = F.lit(T0 + timedelta(seconds=200))
    rows = events(spark, [0, 20], "silent").unionByName(events(spark, [0, 80, 150], "alive"))
    found = health.stale_gaps(rows, ["source"], as_of=as_of).collect()
    assert [(r.source, r.gap_end, r.gap_seconds, r.fired_at) for r in found] == [
        ("silent", None, 180.0, (T0 + timedelta(seconds=110)).replace(tzinfo=None))
    ]
    assert health.stale_gaps(rows.limit(0), as_of=as_of).isEmpty()


def brute_alarm(seconds, threshold, reach, hold, step):
    last = max(seconds) + reach + hold + step
    grid = range(0, last, step)
    over = {t for t in grid if sum(t - reach <= s < t for s in seconds) / reach > threshold}
    return [t for t in grid if all(u in over for u in range(t - hold, t + 1, step))]


@given(st.lists(st.integers(0, 600), min_size=1, max_size=400))
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_alarm_equals_brute_force(spark, seconds):
    got = [int(r[0]) for r in seconds_of(health.rate_alarm(events(spark, seconds), threshold=0.2), "alarm_at")]
    assert got == brute_alarm(seconds, 0.2, 120, 60, 30)


def test_alarm_of_the_contract(spark):
    burst = [i / 2 for i in range(600)]  # two a second for five minutes
    alarms = [int(r[0]) for r in seconds_of(health.rate_alarm(events(spark, burst)), "alarm_at")]
    assert alarms == list(range(150, 331, 30))
    assert health.rate_alarm(events(spark, [i for i in range(300)])).isEmpty()


def test_rates_and_ages(spark):
    rows = health.events_per_second(events(spark, [0, 10, 59, 60])).orderBy("window_start").collect()
    assert [(r.event_count, r.events_per_second) for r in rows] == [(3, 0.05), (1, 1 / 60)]
    bands = [
        health.source_age(events(spark, [0]), F.lit(T0 + timedelta(seconds=s))).first()[1:] for s in (29, 30, 60)
    ]
    assert bands == [(29.0, "ok"), (30.0, "warning"), (60.0, "critical")]
