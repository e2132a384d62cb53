"""Session settings the jobs rely on, and where they may write."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "pulsetide", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: operators of Python tasks import it there."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if any(f.endswith("/pulsetide.zip") for f in context.listFiles):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='pulsetide-')}/pulsetide", "zip", root, "pulsetide")
    context.addPyFile(archive)


def use_utc(spark: SparkSession) -> None:
    """Dates and windows are UTC; a session in another zone would shift them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def use_rocksdb_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def use_batches_of(spark: SparkSession, rows: int) -> None:
    """Python tasks get at most so many rows at once: the JVM and the worker hold a whole batch each."""
    before = int(spark.conf.get(BATCH))
    # Zero and less stand for no bound.
    if not 0 < before <= rows:
        spark.conf.set(BATCH, rows)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """The same for what runs inside."""
    before = spark.conf.get(BATCH)
    use_batches_of(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors do not see the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="pulsetide-")
    return f"{root.rstrip('/')}/pulsetide/{purpose}-{uuid.uuid4().hex}"


def store(rows: DataFrame, folder: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    It is computed once, survives lost executors, and Spark knows its size when
    it plans the joins that use it.
    """
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
