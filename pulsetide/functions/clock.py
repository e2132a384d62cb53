"""Compressed clock: real instants to simulated ones and back."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

from pulsetide.params import SimClock

DAY_MICROS = 86_400_000_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _anchors(clock: SimClock) -> tuple[int, int, float]:
    real = (clock.real_start - EPOCH) // timedelta(microseconds=1)
    sim = (datetime(*clock.sim_start.timetuple()[:3], tzinfo=timezone.utc) - EPOCH) // timedelta(microseconds=1)
    return real, sim, DAY_MICROS / (clock.day_seconds * 1_000_000)


def sim_time(real: Column, clock: SimClock) -> Column:
    real0, sim0, speedup = _anchors(clock)
    elapsed = F.rint((F.unix_micros(real) - real0) * F.lit(speedup)).cast("long")
    return F.timestamp_micros(elapsed + sim0)


def sim_date(real: Column, clock: SimClock) -> Column:
    return sim_time(real, clock).cast("date")


def current_sim_date(clock: SimClock) -> Column:
    return sim_date(F.current_timestamp(), clock)


def real_window_start(day: Column, clock: SimClock) -> Column:
    """First real instant at which ``day`` is the simulated date."""
    real0, _, speedup = _anchors(clock)
    days = F.datediff(day, F.lit(clock.sim_start))
    return F.timestamp_micros(F.rint(days * F.lit(DAY_MICROS / speedup)).cast("long") + real0)


def real_window_end(day: Column, clock: SimClock) -> Column:
    """Exclusive end of the window that starts at ``real_window_start``."""
    return real_window_start(F.date_add(day, 1), clock)
