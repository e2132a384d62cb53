"""Alert episodes: open at the first flagged window, close at the next clear one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsetide.params import ALERT_TYPES
from pulsetide.schemas import EPISODE


def alert_id(patient: Column, kind: Column, triggered: Column) -> Column:
    """Same episode, same id, however often it is computed."""
    return F.concat_ws(":", patient, kind, F.date_format(triggered, "yyyy-MM-dd'T'HH:mm:ssxxx"))


def _day(time: str) -> Column:
    return F.floor(F.unix_micros(F.col(time)) / F.lit(86_400_000_000)).cast("long")


def _at_border(keys: list[str]) -> Window:
    """Order in which the first and last rows of days follow each other; other rows stay with their day."""
    inner = F.when(~F.col("day_first") & ~F.col("day_last"), F.col("day"))
    return Window.partitionBy(*keys, inner).orderBy("window_start")


def pair_changes(changes: DataFrame) -> DataFrame:
    """Changes alternate per patient and type; each opening ends at the next change.

    Most do so within their day. What is still open at a day's end meets the first
    change of the next day that has any: at most two rows per type and day.
    """
    keys = ["patient_id", "alert_type"]
    in_day = Window.partitionBy(*keys, "day").orderBy("window_start")
    ends = changes.withColumn("day", _day("window_start")).withColumns(
        {
            "resolved_at": F.lead("window_end").over(in_day),
            "day_first": F.lag("window_start").over(in_day).isNull(),
            "day_last": F.lead("window_start").over(in_day).isNull(),
        }
    )
    later = F.lead("window_end").over(_at_border(keys))
    ends = ends.withColumn("resolved_at", F.when(F.col("day_last"), later).otherwise(F.col("resolved_at")))
    return (
        ends.where("opened")
        .withColumnRenamed("window_start", "triggered_at")
        .withColumn("alert_id", alert_id(F.col("patient_id"), F.col("alert_type"), F.col("triggered_at")))
        .select(*EPISODE.names)
    )


def alert_episodes(windows: DataFrame) -> DataFrame:
    """All episodes of the given windows, in event time."""
    return pair_changes(flag_changes(windows))


def flag_changes(windows: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Where flags of the given windows open and close, in event time.

    ``held`` has a row for each patient whose alerts (``flags``) are open before the first window.

    A scan in pieces: each day of a patient is ordered by itself, at most 288
    five-minute windows, and keeps only the windows where its flags change and its
    first and last one. The flags at a day's start are those at the end of the
    patient's day before: one more pass over two rows per day. So no task orders a
    patient's history, and a patient's days are worked on in parallel.
    """
    in_day = Window.partitionBy("patient_id", "day").orderBy("window_start")
    nothing = F.array().cast("array<string>")
    states = windows.select(
        "patient_id",
        "window_start",
        "window_end",
        F.coalesce("anomaly_flags", nothing).alias("flags"),
        _day("window_start").alias("day"),
    ).withColumns(
        {
            "before": F.lag("flags").over(in_day),
            "day_first": F.lag("window_start").over(in_day).isNull(),
            "day_last": F.lead("window_start").over(in_day).isNull(),
        }
    )
    kept = states.where("day_first OR day_last OR flags <> before")
    if held is not None:
        border = {"day_first": F.lit(True), "day_last": F.lit(True)}
        kept = kept.unionByName(held.select("patient_id", "flags").withColumns(border), allowMissingColumns=True)
    # What is held has no time, so it comes first.
    earlier = F.lag("flags").over(_at_border(["patient_id"]))
    kept = kept.withColumn("before", F.coalesce(F.when(F.col("day_first"), earlier).otherwise(F.col("before")), nothing))
    if held is not None:
        kept = kept.where("day IS NOT NULL")
    return kept.select(
        "patient_id",
        "window_start",
        "window_end",
        F.explode(
            F.concat(
                _marked(F.array_except("flags", "before"), True),
                _marked(F.array_except("before", "flags"), False),
            )
        ).alias("change"),
    ).select("patient_id", "window_start", "window_end", "change.*")


def _marked(types: Column, opened: bool) -> Column:
    return F.transform(types, lambda t: F.struct(t.alias("alert_type"), F.lit(opened).alias("opened")))


def open_alerts(episodes: DataFrame) -> DataFrame:
    return episodes.where(F.col("resolved_at").isNull())


def oldest_open(episodes: DataFrame) -> DataFrame:
    """The oldest open alert per patient and type."""
    return (
        open_alerts(episodes)
        .groupBy("patient_id", "alert_type")
        .agg(F.min("triggered_at").alias("triggered_at"))
        .withColumn("alert_id", alert_id(F.col("patient_id"), F.col("alert_type"), F.col("triggered_at")))
    )


def newly_opened(flagged: DataFrame, episodes: DataFrame) -> DataFrame:
    """Flags of single windows that have no open alert of their type yet."""
    flags = flagged.select(
        "patient_id", F.explode("anomaly_flags").alias("alert_type"), F.col("window_start").alias("triggered_at")
    )
    first = flags.groupBy("patient_id", "alert_type").agg(F.min("triggered_at").alias("triggered_at"))
    return first.join(open_alerts(episodes), ["patient_id", "alert_type"], "left_anti")


def closed_by(cleared: DataFrame, episodes: DataFrame) -> DataFrame:
    """Open alerts that a later window without their flag closes, with the time.

    Alerts and windows are sorted together, latest first, and the end of the next
    window without a flag runs along per type: each row is sorted once, and no alert
    is paired with its patient's windows.
    """
    windows = cleared.select("patient_id", F.col("window_start").alias("at"), "window_end", "anomaly_flags")
    alerts = open_alerts(episodes).select(
        "patient_id", F.col("triggered_at").alias("at"), "alert_id", "alert_type", "triggered_at"
    )
    rows = windows.unionByName(alerts, allowMissingColumns=True)
    # A window that starts as the alert does may close it, so it comes first.
    latest_first = Window.partitionBy("patient_id").orderBy(F.desc("at"), F.col("alert_id").isNotNull())
    running = latest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_clear = {
        kind: F.min(F.when(~F.array_contains("anomaly_flags", kind), F.col("window_end"))).over(running) for kind in ALERT_TYPES
    }
    chosen = F.coalesce(*[F.when(F.col("alert_type") == kind, end) for kind, end in next_clear.items()])
    closed = rows.withColumn("resolved_at", chosen).where("alert_id IS NOT NULL AND resolved_at IS NOT NULL")
    return closed.select("alert_id", "patient_id", "alert_type", "triggered_at", "resolved_at")
