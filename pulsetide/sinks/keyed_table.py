"""Keyed table as Parquet: changes appended per version, latest version wins.

Without a lakehouse format there is no MERGE. A version is one folder, written
whole and replaced whole when a batch is retried, so a retry leaves no trace.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from pulsetide.operators.upsert import latest_by_key
from pulsetide.sources.files import is_complete, list_folder, remove_folder


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        dates: Mapping[str, str] | None = None,
    ):
        """``dates`` names folder columns and the SQL of key columns that gives each one's date."""
        self.spark, self.path, self.keys, self.dates = spark, path.rstrip("/"), list(keys), dict(dates or {})
        self.columns, self.partition_by = schema.names, [*partition_by, *self.dates]
        folders = [T.StructField(name, T.DateType()) for name in self.dates]
        self.schema = T.StructType(schema.fields + folders + [T.StructField("deleted", T.BooleanType())])

    def write_changes(self, rows: DataFrame, version: int) -> None:
        """Store one batch of changed rows; a row with ``deleted`` removes its key."""
        if "deleted" not in rows.columns:
            rows = rows.withColumn("deleted", F.lit(False))
        self._write(rows, f"{self.path}/changes/version={version}")

    def changes(self, version: int) -> DataFrame:
        return self._read([f"{self.path}/changes/version={version}"]).select(*self.columns, "deleted")

    def current(
        self, before: int | None = None, only: Callable[[DataFrame], DataFrame] | None = None
    ) -> DataFrame:
        """Latest row per key, of versions below ``before`` if given.

        Filters on key columns reach the scan: Spark pushes them below the
        grouping, and partition columns prune folders. Joins are not pushed
        down: ``only`` is applied to the stored rows before they are grouped,
        and may select by key and ``dates`` columns.
        """
        base = self._versions("base", before=before)[-1:]
        later = self._versions("changes", after=base[0] if base else None, before=before)
        folders = [f"{self.path}/base/version={v}" for v in base] + [f"{self.path}/changes/version={v}" for v in later]
        rows = only(self._read(folders)) if only else self._read(folders)
        latest = rows if base and not later else latest_by_key(rows, self.keys, "version")
        return latest.where("NOT deleted").select(*self.columns)

    def compact(self, upto: int) -> None:
        """Merge versions up to ``upto`` into a new base; its sources stay for running readers.

        A finished base is left as it is, so a retried batch may compact again.
        """
        if upto in self._versions("base", after=upto - 1, before=upto + 1):
            return
        rows = self.current(before=upto + 1).withColumn("deleted", F.lit(False))
        self._write(rows, f"{self.path}/base/version={upto}")

    def vacuum(self) -> None:
        """Remove versions that the base before the latest one already holds."""
        bases = self._versions("base")
        if len(bases) < 2:
            return
        kept = bases[-2]
        old = [("base", v) for v in self._listed("base") if v < kept]
        old += [("changes", v) for v in self._listed("changes") if v <= kept]
        for kind, version in old:
            remove_folder(self.spark, f"{self.path}/{kind}/version={version}")

    def last_version(self) -> int | None:
        return max(self._versions("changes") + self._versions("base"), default=None)

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows = rows.withColumns({name: F.expr(sql) for name, sql in self.dates.items()})
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        writer = typed.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(folder)

    def _listed(self, kind: str) -> list[int]:
        return sorted(int(e.name.split("=")[1]) for e in list_folder(self.spark, f"{self.path}/{kind}"))

    def _versions(self, kind: str, after: int | None = None, before: int | None = None) -> list[int]:
        """Committed versions between the bounds, both exclusive."""
        near = [v for v in self._listed(kind) if (after is None or v > after) and (before is None or v < before)]
        return [v for v in near if is_complete(self.spark, f"{self.path}/{kind}/version={v}")]

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema).withColumn("version", F.lit(0))
        parts = []
        for kind in ("base", "changes"):
            named = [f for f in folders if f"/{kind}/" in f]
            if named:
                reader = self.spark.read.schema(T.StructType(self.schema.fields + [T.StructField("version", T.LongType())]))
                parts.append(reader.option("basePath", f"{self.path}/{kind}").parquet(*named))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
