"""Alarms on streams against the batch forms of the same rules."""

import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import plain
from pulsetide.operators import health
from pulsetide.streaming import alarms
from tests.conftest import rows_of, utc

T0 = utc(2026, 1, 1, 12)
SCHEMA = "source string, timestamp timestamp, bad boolean"


def land(spark, folder, *rows):
    """(source, second, bad) rows as one more file."""
    values = [(s, T0 + timedelta(seconds=x), bad) for s, x, bad in rows]
    spark.createDataFrame(values, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def turn(spark, folder, start):
    """All that has landed since the last turn, from the checkpoint on."""
    rows = start(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out")
    writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def seconds(rows):
    times = [c for c in rows.columns if c != "source"]
    out = rows.select("source", *[((F.unix_micros(c) / 1e6) - T0.timestamp()).alias(c) for c in times])
    return sorted(rows_of(out), key=repr)


def silence(events):
    return alarms.stale_alarms(events, "source", watermark="10 seconds")


def test_a_silent_source_rings_after_a_restart(spark, tmp_path):
    land(spark, tmp_path, ("a", 0, False), ("b", 5, False), ("a", 30, False))
    assert seconds(turn(spark, tmp_path, silence)) == []
    # b goes on; only its events move the clock past a's limit of 90 seconds.
    land(spark, tmp_path, ("b", 80, False), ("b", 150, False))
    assert seconds(turn(spark, tmp_path, silence)) == []
    land(spark, tmp_path, ("b", 230, False))
    assert seconds(turn(spark, tmp_path, silence)) == [("a", 30.0, 120.0, None)]
    # It rings once; its end is told when the source is back.
    land(spark, tmp_path, ("b", 310, False), ("a", 400, False))
    land(spark, tmp_path, ("b", 390, False), ("b", 470, False), ("a", 480, False), ("b", 550, False), (None, 600, False))
    assert seconds(turn(spark, tmp_path, silence)) == [("a", 30.0, 120.0, 400.0), ("a", 30.0, 120.0, None)]
    found = alarms.silences(spark.read.schema(alarms.SILENCE).parquet(f"{tmp_path}/out"))
    assert seconds(found) == [("a", 30.0, 120.0, 400.0)]


def test_rows_without_a_source_move_the_clock(spark, tmp_path):
    land(spark, tmp_path, ("a", 0, False))
    land(spark, tmp_path, (None, 1000, False))
    assert seconds(turn(spark, tmp_path, silence)) == [("a", 0.0, 90.0, None)]


def test_silences_equal_the_gaps_of_the_batch(spark, tmp_path):
    """Sources of many rhythms, one of them with most events, gaps at and around the limit."""
    rows = [("hot", x, False) for x in range(0, 2000, 2)] + [("limit", x * 90, False) for x in range(20)]
    rows += [("beyond", x * 91, False) for x in range(20)] + [("late", 50, False), ("late", 1500, False)]
    land(spark, tmp_path, *rows)
    land(spark, tmp_path, (None, 5000, False))
    found = alarms.silences(turn(spark, tmp_path, silence))
    whole = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in").where("source IS NOT NULL")
    gaps = health.stale_gaps(whole, ["source"], as_of=F.lit(T0 + timedelta(seconds=5000)))
    assert seconds(found.select("source", "gap_start", "fired_at", "gap_end")) == seconds(gaps.select("source", "gap_start", "fired_at", "gap_end"))


def test_wall_clock_rings_while_nothing_arrives(spark, tmp_path):
    land(spark, tmp_path, ("a", 0, False), ("b", 1, False))
    events = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    rows = alarms.stale_alarms(events, "source", stale_after=1, hold=1, wall_clock=True)
    writer = rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
    query = writer.trigger(processingTime="1 second").start()
    try:
        until = time.time() + 60
        while time.time() < until:
            time.sleep(2)
            got = seconds(spark.read.schema(alarms.SILENCE).parquet(f"{tmp_path}/out")) if (tmp_path / "out" / "_spark_metadata").exists() else []
            if len(got) == 2:
                break
        time.sleep(4)
    finally:
        query.stop()
    assert seconds(spark.read.schema(alarms.SILENCE).parquet(f"{tmp_path}/out")) == [("a", 0.0, 2.0, None), ("b", 1.0, 3.0, None)]


def rate(events):
    return alarms.rate_alarms(events, "bad", threshold=0.05, range_seconds=120, hold_seconds=60, step_seconds=30, watermark="10 seconds")


def test_rate_alarm_equals_that_of_the_batch(spark, tmp_path):
    burst = [(None, x, True) for x in range(100, 400, 7)] + [("a", x, False) for x in range(0, 900, 11)]
    short = [(None, 1200 + x, True) for x in range(8)]
    land(spark, tmp_path, *burst)
    land(spark, tmp_path, *short)
    # Good events alone let the alarm ring, across a restart.
    turn(spark, tmp_path, rate)
    land(spark, tmp_path, ("a", 9000, False))
    got = turn(spark, tmp_path, rate)
    bad = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in").where("bad")
    expected = health.rate_alarm(bad, threshold=0.05)
    assert expected.count() > 3
    assert sorted(rows_of(plain(got))) == sorted(rows_of(plain(expected)))


def test_rate_alarm_wants_multiples_of_the_step(spark, tmp_path):
    land(spark, tmp_path, ("a", 0, True))
    with pytest.raises(ValueError):
        alarms.rate_alarms(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), "bad", step_seconds=50)
