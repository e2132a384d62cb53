"""Alerts kept in step with windows that arrive late or change."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsetide.operators.episodes import flag_changes, pair_changes
from pulsetide.params import ALERT_TYPES
from pulsetide.sinks.keyed_table import KeyedTable

EPISODE_KEY = ["patient_id", "alert_type", "triggered_at"]


def fold_from(windows: DataFrame, carried: DataFrame) -> DataFrame:
    """Episodes per patient and type from the windows, and from alerts open before the first of them.

    A window is one row until its flags change, whatever the number of types.
    """
    known = F.array(*[F.lit(k) for k in ALERT_TYPES])
    openings = carried.groupBy("patient_id", "alert_type").agg(F.min("triggered_at").alias("window_start"))
    held = openings.groupBy("patient_id").agg(F.array_intersect(F.collect_set("alert_type"), known).alias("flags"))
    changes = flag_changes(windows.withColumn("anomaly_flags", F.array_intersect("anomaly_flags", known)), held)
    return pair_changes(changes.unionByName(openings.withColumn("opened", F.lit(True)), allowMissingColumns=True))


def changed_episodes(live: KeyedTable, alerts: KeyedTable, version: int) -> tuple[DataFrame, DataFrame]:
    """Windows of the touched patients since their first change, and the stored episodes these may alter.

    Patients and times are selected before the stored rows are grouped. Windows
    are pruned to the days since the oldest change of this version, which the
    watermark bounds: an alert that opened long ago is carried in as it is
    stored, its old windows are not read again.
    """
    touched = live.changes(version).groupBy("patient_id").agg(F.min("window_start").alias("changed_from"))
    first_day = touched.agg(F.min(F.to_date("changed_from"))).first()[0]

    def since(rows: DataFrame) -> DataFrame:
        recent = rows.where(F.col("window_date") >= F.lit(first_day)).alias("stored")
        same = F.col("stored.patient_id") == F.col("touched.patient_id")
        later = F.col("stored.window_start") >= F.col("touched.changed_from")
        return recent.join(touched.alias("touched"), same & later, "left_semi")

    windows = live.current(before=version + 1, only=since)
    stored = alerts.current(before=version, only=lambda rows: rows.join(touched, "patient_id", "left_semi"))
    reaching = F.col("resolved_at").isNull() | (F.col("resolved_at") > F.col("changed_from"))
    known = stored.join(touched, "patient_id").where((F.col("triggered_at") >= F.col("changed_from")) | reaching)
    return windows, known


def reconcile_alerts(live: KeyedTable, alerts: KeyedTable, version: int) -> DataFrame:
    """Episodes to add, change or delete after the windows of ``version`` were stored.

    Per touched patient the fold starts at the oldest changed window, with the
    alerts that were open just before it. Earlier episodes cannot change. The
    result depends on stored windows only, not on arrival order.
    """
    windows, stored = changed_episodes(live, alerts, version)
    carried = stored.where(F.col("triggered_at") < F.col("changed_from"))
    fresh = fold_from(windows, carried).withColumn("found", F.lit(True))
    known = stored.select(
        *EPISODE_KEY, F.col("alert_id").alias("old_id"), F.col("resolved_at").alias("old_end"), F.lit(True).alias("known")
    )
    both = fresh.join(known, EPISODE_KEY, "full")
    changed = F.col("known").isNull() | F.col("found").isNull() | ~F.col("resolved_at").eqNullSafe(F.col("old_end"))
    return both.where(changed).select(
        F.coalesce("alert_id", "old_id").alias("alert_id"),
        *EPISODE_KEY,
        "resolved_at",
        F.col("found").isNull().alias("deleted"),
    )
