"""Latest version per key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_by_key(rows: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row with the highest ``order`` per key, all of its columns.

    ``max`` over a struct combines on the map side, so many versions of one key
    shrink to one per task before the shuffle; a ranking window would move them
    all. The other columns break ties, so a retried task picks the same row.
    """
    values = [c for c in rows.columns if c not in keys and c not in order]
    latest = F.max(F.struct(*order, *values)).alias("latest")
    return rows.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*rows.columns)


def latest_given(rows: DataFrame, keys: Sequence[str], order: str, given: str = "given") -> DataFrame:
    """One row per key, each column with its value from the latest row that gives it.

    ``given`` lists the columns a row sets, so a null that is set replaces a value and
    a column left out keeps it. A column no row gives is null. Equal ``order`` is settled by
    the value. One maximum per column, combined on the map side.
    """
    values = [c for c in rows.columns if c not in (*keys, order, given)]
    latest = [
        F.max(F.when(F.array_contains(given, c), F.struct(order, F.col(c).alias("value"))))["value"].alias(c) for c in values
    ]
    return rows.groupBy(*keys).agg(*latest).select(*[c for c in rows.columns if c not in (order, given)])


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates replace rows of the same key, other rows stay. Updates hold each key once."""
    return existing.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)
