"""Readings from topics, text files and the archive."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsetide.operators.clean import typed_readings
from pulsetide.schemas import ARCHIVE, RAW_READING, RAW_TEXT
from pulsetide.sources.files import list_folder


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", keep_text: bool = False, **options: str
) -> DataFrame:
    """Subscribe to a topic of JSON readings. Needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    return decode_readings(reader.options(**options).load(), keep_text=keep_text)


def decode_readings(messages: DataFrame, value: str = "value", keep_text: bool = False) -> DataFrame:
    """JSON payload to text columns; an undecodable payload gives a row of nulls.

    Vitals stay text here: decoding to DOUBLE would turn "80" and junk alike
    into null, and cleaning could no longer tell them apart. With ``keep_text`` the
    payload as it was sent stays beside them (``raw_text``), so that dead letters
    hold it whole: numbers as written, fields that no column knows, broken text.
    """
    text = F.col(value).cast("string")
    event = F.from_json(text, RAW_READING)
    rest = ["arrival"] if "arrival" in messages.columns else []
    sent = [text.alias(RAW_TEXT)] if keep_text else []
    # inline keeps later filters above the decoding, which would else be repeated in them.
    rows = messages.select(*rest, *sent, F.inline(F.array(event)))
    return rows.select(*RAW_READING.names, *rest, *([RAW_TEXT] if keep_text else []))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Readings of JSON-lines files, bad lines kept as rows of nulls.

    ``arrival`` orders the lines of a file, so that the first copy of an event
    can be kept: blocks by their start, lines by their place in the block.
    """
    lines = spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("arrival"),
    )
    return decode_readings(lines)


def _text_reader(spark: SparkSession):
    return spark.read.schema(RAW_READING)


def _archive_files(spark: SparkSession, suffix: str, paths: list[str]) -> DataFrame:
    if suffix == "parquet":
        # Options of the folder layout do not matter here: files are named one by one.
        rows = spark.read.parquet(*paths)
    elif suffix == "jsonl":
        rows = _text_reader(spark).json(paths)
    elif suffix == "json":
        rows = _text_reader(spark).option("multiLine", True).json(paths)
    else:
        raise ValueError(f"unsupported archive format: {suffix!r}")
    return typed_readings(rows).drop("unreadable")


def read_archive_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Readings of archive files of several formats; any other suffix is an error."""
    by_suffix: dict[str, list[str]] = {}
    for path in paths:
        by_suffix.setdefault(path.rsplit(".", 1)[-1], []).append(path)
    parts = [_archive_files(spark, suffix, names) for suffix, names in sorted(by_suffix.items())]
    if not parts:
        return spark.createDataFrame([], ARCHIVE)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_archive_day(spark: SparkSession, root: str, day: date) -> DataFrame:
    """One date partition, whatever its files' formats; empty if there is none."""
    entries = list_folder(spark, f"{root}/date={day.isoformat()}")
    return read_archive_files(spark, [e.path for e in entries if not e.is_folder])


def read_archive(spark: SparkSession, root: str, first: date, last: date) -> DataFrame:
    """The Parquet archive between two dates; other partitions are not opened."""
    return spark.read.schema(ARCHIVE).parquet(root).where(F.col("date").between(F.lit(first), F.lit(last)))
