"""Pipeline health from the data itself: rates, ages, gaps, alarms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values of the alarm rules and the dashboard bands, in seconds.
STALE_AFTER, STALE_HOLD = 60, 30
AGE_WARNING, AGE_CRITICAL = 30, 60
DLQ_RATE, DLQ_RANGE, DLQ_HOLD = 1.0, 120, 60


def _slot(time: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(time)) / F.lit(seconds * 1_000_000)).cast("long")


def _second(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def events_per_second(events: DataFrame, time: str = "timestamp", seconds: int = 60) -> DataFrame:
    """Average rate of each tumbling window that has events."""
    grouped = events.groupBy(F.window(time, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("event_count"))
    return grouped.select(
        F.col("w.start").alias("window_start"),
        "event_count",
        (F.col("event_count") / F.lit(float(seconds))).alias("events_per_second"),
    )


def source_age(events: DataFrame, as_of: Column, by: Sequence[str] = (), time: str = "timestamp") -> DataFrame:
    """Seconds since the last event of each source, with its band."""
    latest = events.groupBy(*by).agg(F.max(time).alias("last_event"))
    age = (F.unix_micros(as_of) - F.unix_micros("last_event")) / F.lit(1_000_000.0)
    band = F.when(F.col("age_seconds") >= AGE_CRITICAL, "critical").when(F.col("age_seconds") >= AGE_WARNING, "warning")
    return latest.withColumn("age_seconds", age).withColumn("band", band.otherwise("ok"))


def stale_gaps(
    events: DataFrame,
    by: Sequence[str] = (),
    time: str = "timestamp",
    stale_after: int = STALE_AFTER,
    hold: int = STALE_HOLD,
    as_of: Column | None = None,
) -> DataFrame:
    """Silences longer than ``stale_after + hold`` seconds: when each began, fired and ended.

    With ``as_of``, a source silent up to that instant has a row too: its
    ``gap_end`` is null and its length is counted up to ``as_of``.

    A gap that long never lies inside one slot of that length, so the first and
    last event of each slot are enough. They combine on the map side, and the
    ordered step sees at most one row per slot and source, whatever the number
    of events. That step is itself split by day: only the first and last event
    of a day meet across days.
    """
    limit = stale_after + hold
    day = F.floor(F.col("slot") * F.lit(limit) / F.lit(86400)).cast("long")
    slots = (
        events.groupBy(*by, _slot(time, limit).alias("slot"))
        .agg(F.min(time).alias("first_event"), F.max(time).alias("last_event"))
        .withColumn("day", day)
    )
    days = slots.groupBy(*by, "day").agg(F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))
    inside = _gaps(slots, Window.partitionBy(*by, "day").orderBy("slot"), by)
    across = _gaps(days, Window.partitionBy(*(by or [F.lit(0)])).orderBy("day"), by)
    spans = inside.unionByName(across).withColumn("silent_until", F.col("gap_end"))
    if as_of is not None:
        last = days.groupBy(*by).agg(F.max("last_event").alias("gap_start"))
        none = F.lit(None).cast("timestamp")
        spans = spans.unionByName(last.withColumns({"gap_end": none, "silent_until": as_of.cast("timestamp")}))
    length = (F.unix_micros("silent_until") - F.unix_micros("gap_start")) / F.lit(1_000_000.0)
    return (
        spans.withColumn("gap_seconds", length)
        .drop("silent_until")
        .where(F.col("gap_seconds") > limit)
        .withColumn("fired_at", F.timestamp_micros(F.unix_micros("gap_start") + F.lit(limit * 1_000_000)))
    )


def _gaps(spans: DataFrame, in_order: Window, by: Sequence[str]) -> DataFrame:
    ends = spans.select(
        *by, F.col("last_event").alias("gap_start"), F.lead("first_event").over(in_order).alias("gap_end")
    )
    return ends.where(F.col("gap_end").isNotNull())


def rate_alarm(
    events: DataFrame,
    time: str = "timestamp",
    threshold: float = DLQ_RATE,
    range_seconds: int = DLQ_RANGE,
    hold_seconds: int = DLQ_HOLD,
    step_seconds: int = 30,
) -> DataFrame:
    """Instants at which the rate over the past range has stayed above the threshold for the hold time.

    Events are counted per step before anything is spread: each step count is
    then added to the ranges it lies in, and each range over the threshold to
    the instants it supports. Both are plain grouped sums, so no ordered pass
    over the whole history is needed.
    """
    if range_seconds % step_seconds or hold_seconds % step_seconds:
        raise ValueError("range and hold must be multiples of the step")
    steps = events.groupBy(_slot(time, step_seconds).alias("step")).agg(F.count("*").alias("n"))
    reach = range_seconds // step_seconds
    ranges = (
        steps.select("n", F.explode(F.sequence(F.col("step") + 1, F.col("step") + reach)).alias("at"))
        .groupBy("at")
        .agg((F.sum("n") / F.lit(float(range_seconds))).alias("rate"))
        .where(F.col("rate") > threshold)
    )
    support = hold_seconds // step_seconds
    held = (
        ranges.select("rate", F.col("at").alias("own"), F.explode(F.sequence(F.col("at"), F.col("at") + support)).alias("at"))
        .groupBy("at")
        .agg(F.count("*").alias("over"), F.max(F.when(F.col("own") == F.col("at"), F.col("rate"))).alias("rate"))
        .where(F.col("over") == support + 1)
    )
    return held.select(_second(F.col("at") * step_seconds).alias("alarm_at"), "rate")


def dead_letter_totals(rejected: DataFrame) -> DataFrame:
    """Dead letters per reason."""
    return rejected.groupBy("invalid_detail").agg(F.count("*").alias("dead_letters"))


def dead_letters_over_time(rejected: DataFrame, time: str = "timestamp", seconds: int = 60) -> DataFrame:
    """Dead letters per reason and tumbling window; ``time`` is when they came, as their own time may be bad."""
    counted = rejected.groupBy(F.window(time, f"{seconds} seconds").alias("w"), "invalid_detail")
    return counted.agg(F.count("*").alias("dead_letters")).select(
        F.col("w.start").alias("window_start"), "invalid_detail", "dead_letters"
    )


def file_counts(verdicts: DataFrame) -> DataFrame:
    """Accepted and rejected lab files."""
    return verdicts.agg(
        F.count_if("accepted").alias("accepted_files"), F.count_if(~F.col("accepted")).alias("rejected_files")
    )
