"""Alarms on a live stream: a feed that falls silent, and too many dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from pulsetide.operators.health import DLQ_HOLD, DLQ_RANGE, DLQ_RATE, STALE_AFTER, STALE_HOLD
from pulsetide.params import WATERMARK
from pulsetide.session import use_rocksdb_state

SILENCE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("gap_start", T.TimestampType()),
        T.StructField("fired_at", T.TimestampType()),
        T.StructField("gap_end", T.TimestampType()),
    ]
)


def _silence(limit: int, slot: int, wall_clock: bool):
    # Local classes travel to the workers by value: executors need no copy of this package.
    from datetime import datetime, timedelta, timezone

    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

    seen = T.StructType([T.StructField("micros", T.LongType())])
    change = Row(*SILENCE.names)
    epoch, micro = datetime(1970, 1, 1, tzinfo=timezone.utc), 1_000_000

    def when(micros: int) -> datetime:
        return epoch + timedelta(microseconds=micros)

    class Silence(StatefulProcessor):
        """State: a source's last event. A timer stands where its silence becomes an alarm."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", seen)

        def handleInputRows(self, key, rows, timerValues):
            # Rows without a source only move the clock. A filter would go below the watermark, and they would not.
            if key[0] is None:
                return
            last = self.last.get()[0] if self.last.exists() else None
            for first, latest in sorted((r.first_event, r.last_event) for r in rows):
                if last is not None and first - last > limit * micro:
                    yield change(key[0], when(last), when(last + limit * micro), when(first))
                last = latest if last is None else max(last, latest)
            self.last.update((last,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if wall_clock:
                due = timerValues.getCurrentProcessingTimeInMs() + limit * 1000
            else:
                # Events up to the limit may still wait in their slot: the alarm rings when that slot is closed.
                due = ((last + limit * micro) // (slot * micro) + 1) * slot * 1000
            self.handle.registerTimer(due)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            last = self.last.get()[0]
            yield change(key[0], when(last), when(last + limit * micro), None)

        def close(self) -> None:
            pass

    return Silence()


def stale_alarms(
    events: DataFrame,
    by: str,
    time: str = "timestamp",
    stale_after: int = STALE_AFTER,
    hold: int = STALE_HOLD,
    watermark: str = WATERMARK,
    wall_clock: bool = False,
) -> DataFrame:
    """Silences of each source longer than ``stale_after + hold`` seconds, as they happen: source, gap_start, fired_at, gap_end.

    A timer per source rings while nothing comes from it: its row has no gap_end. When
    the source is back, a row of the same gap_start has one; a silence that ended before
    its alarm could ring has that row alone. Timers and last events are state, so a
    restarted stream rings for a source that fell silent before.

    In event time the clock is the watermark: other sources, or rows without a source,
    move it. Events are combined per source and slot first, so a source with a third of
    all events is one row per slot; the alarm rings when the slot that holds its time is
    closed. With ``wall_clock`` timers follow the processing time instead: they ring
    also when no source sends anything, for events as they arrive.
    """
    use_rocksdb_state(events.sparkSession)
    limit = stale_after + hold
    mode = "ProcessingTime" if wall_clock else "EventTime"
    rows = events.select(F.col(by).cast("string").alias("source"), F.col(time).alias("timestamp"))
    if wall_clock:
        own = F.unix_micros("timestamp")
        slots = rows.select("source", own.alias("first_event"), own.alias("last_event"))
    else:
        grouped = rows.withWatermark("timestamp", watermark).groupBy(F.window("timestamp", f"{limit} seconds").alias("w"), "source")
        slots = grouped.agg(F.unix_micros(F.min("timestamp")).alias("first_event"), F.unix_micros(F.max("timestamp")).alias("last_event"))
        slots = slots.select("source", "first_event", "last_event", F.window_time("w").alias("closed"))
    return slots.groupBy("source").transformWithState(_silence(limit, limit, wall_clock), SILENCE, "Append", mode)


def silences(alarms: DataFrame) -> DataFrame:
    """One row per silence from stored alarms; gap_end is null while it lasts."""
    return alarms.groupBy("source", "gap_start").agg(F.max("fired_at").alias("fired_at"), F.max("gap_end").alias("gap_end"))


def rate_alarms(
    events: DataFrame,
    condition: str,
    time: str = "timestamp",
    threshold: float = DLQ_RATE,
    range_seconds: int = DLQ_RANGE,
    hold_seconds: int = DLQ_HOLD,
    step_seconds: int = 30,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Instants at which the rate of the events that meet the condition has stayed above the threshold for the hold time.

    Two chained sliding windows in append mode: counts over the past range at each step,
    and of the ranges above the threshold as many as the hold time asks for. Counts
    combine before the shuffle. The watermark follows all events, those that do not
    meet the condition too, so an alarm does not wait for the next bad one.
    """
    if range_seconds % step_seconds or hold_seconds % step_seconds:
        raise ValueError("range and hold must be multiples of the step")
    use_rocksdb_state(events.sparkSession)
    step = f"{step_seconds} seconds"
    # The filter names the time, so that it stays above the watermark, which all events move.
    bad = events.withWatermark(time, watermark).where(F.when(F.expr(condition), F.col(time)).isNotNull())
    ranges = (
        bad.groupBy(F.window(time, f"{range_seconds} seconds", step).alias("w"))
        .agg((F.count("*") / F.lit(float(range_seconds))).alias("rate"))
        .where(F.col("rate") > threshold)
        .select("rate", F.col("w.end").alias("at"), F.window_time("w").alias("closed"))
    )
    held = ranges.groupBy(F.window("closed", f"{hold_seconds + step_seconds} seconds", step).alias("w")).agg(
        F.count("*").alias("over"), F.max("at").alias("latest"), F.max_by("rate", "at").alias("rate")
    )
    full = (F.col("over") == hold_seconds // step_seconds + 1) & (F.col("latest") == F.col("w.end"))
    return held.where(full).select(F.col("w.end").alias("alarm_at"), "rate")
