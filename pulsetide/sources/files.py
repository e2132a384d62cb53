"""Listing of folders through Hadoop, so that any supported file system works."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    path: str
    name: str
    size: int
    is_folder: bool


def list_folder(spark: SparkSession, folder: str) -> list[Entry]:
    """Visible entries of a folder (names only, no contents); empty if it is not there."""
    path, fs = _open(spark, folder)
    if not fs.exists(path):
        return []
    found = [
        Entry(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.isDirectory()) for s in fs.listStatus(path)
    ]
    return sorted(e for e in found if not e.name.startswith((".", "_")))


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a Spark write to this folder was committed."""
    path, fs = _open(spark, f"{folder}/_SUCCESS")
    return fs.exists(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path, fs = _open(spark, folder)
    fs.delete(path, True)


def _open(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
