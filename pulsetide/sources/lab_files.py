"""Daily lab CSV files with any order of the five columns."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from pulsetide.functions.parsing import parse_once
from pulsetide.operators.labs import lab_row_error, typed_labs
from pulsetide.params import LAB_COLUMNS
from pulsetide.schemas import LAB

POSITIONS = [f"c{i}" for i in range(len(LAB_COLUMNS))]
CSV = {"escape": '"', "mode": "PERMISSIVE"}


def lab_text(text: DataFrame) -> DataFrame:
    """Lines of a text source, batch or stream, with their file and block."""
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def in_file_order(lines: DataFrame) -> DataFrame:
    """Add the place of a line within its block. Batch only: a stream has no row ids."""
    return lines.withColumn("line", F.monotonically_increasing_id())


def read_lab_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one lab file, or of all below a folder."""
    return in_file_order(lab_text(_lab_files(spark, path)))


def _lab_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).text(path)


def stream_lab_text(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return lab_text(reader.load(folder))


# A field as a plain CSV reader takes it: quoted, with doubled quotes inside; or bare, where quotes are text.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
#: A line that starts outside quotes and ends there; and one that starts inside a quoted field and ends outside.
WHOLE_LINE = rf'^{_FIELD}(?:,{_FIELD})*+$'
CLOSING_LINE = rf'^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+$'


def headers(lines: DataFrame) -> DataFrame:
    """First line of each file, whether it names exactly the five lab columns, in any order, and whether a quoted field may hold line breaks."""
    first = lines.groupBy("source_file").agg(
        F.min_by("value", F.when(F.col("block") == 0, F.col("line"))).alias("header"),
        F.coalesce(F.bool_or(~F.col("value").rlike(WHOLE_LINE)), F.lit(False)).alias("breaks"),
    )
    expected = ", ".join(f"'{c}'" for c in sorted(LAB_COLUMNS))
    return first.selectExpr("*", "split(replace(header, '\"', ''), ',') AS names").selectExpr(
        "source_file", "header", "names", f"array_sort(names) = array({expected}) AS header_ok", "breaks"
    )


def with_line_breaks(lines: DataFrame) -> DataFrame:
    """Lines joined to records where a quoted field goes on over a line's end: source_file and value.

    Each line maps the two states, inside and outside quotes, to the state at its end. Lines
    that map both to the same state settle it, the others keep or turn it, so the state before
    any line is the last settled one, turned as often as lines turn it since. That is a running
    sum inside each block of a file; one row per block carries the state, and the record that is
    open, into the next. No task orders more than a block.
    """
    # Ends inside from outside; ends inside from inside.
    state = lines.withColumn("from_out", ~F.col("value").rlike(WHOLE_LINE)).withColumn("from_in", ~F.col("value").rlike(CLOSING_LINE))
    settles = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out"))
    turns = (F.col("from_out") & ~F.col("from_in")).cast("int")
    state = state.withColumn("settles", settles).withColumn("turns", turns)
    in_block = Window.partitionBy("source_file", "block").orderBy("line")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    running = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = state.withColumn("turned", F.coalesce(F.sum("turns").over(before), F.lit(0)))
    # The last settled state, and how many turns came before it and with it.
    mark = F.when(F.col("settles").isNotNull(), F.struct("line", "settles", "turned"))
    state = state.withColumn("mark", F.last(mark, ignorenulls=True).over(before))
    # A record is named by the line it starts with; both cases, a block that starts outside and inside, are followed.
    own = (F.col("mark.settles").cast("int") + F.col("turned") - F.col("mark.turned")) % 2 == 1
    records = ["if_out", "if_in"]
    for case, name in enumerate(records):
        inside = F.coalesce(F.when(F.col("mark").isNotNull(), own), (F.col("turned") + case) % 2 == 1)
        start = F.when(~inside, F.struct("block", "line"))
        state = state.withColumn(name, F.last(start, ignorenulls=True).over(running))
    whole = state.groupBy("source_file", "block").agg(
        F.max(mark).alias("mark"), F.sum("turns").alias("turns"), *[F.max(name).alias(name) for name in records]
    )
    blocks = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("turned", F.coalesce(F.sum("turns").over(blocks), F.lit(0)))
    across = F.when(F.col("mark").isNotNull(), F.struct("block", F.col("mark.settles").alias("settles"), (F.col("turned") + F.col("mark.turned")).alias("turned")))
    whole = whole.withColumn("earlier", F.last(across, ignorenulls=True).over(blocks))
    known = F.coalesce(F.col("earlier.settles"), F.lit(False)).cast("int")
    since = F.col("turned") - F.coalesce(F.col("earlier.turned"), F.lit(0))
    whole = whole.withColumn("inside_at_start", (known + since) % 2 == 1)
    record = F.when(F.col("inside_at_start"), F.col("if_in")).otherwise(F.col("if_out"))
    # A block's first lines may belong to a record of an earlier block.
    carried = F.last(record, ignorenulls=True).over(blocks).alias("carried")
    whole = whole.select("source_file", "block", "inside_at_start", carried)

    rows = state.join(whole, ["source_file", "block"]).withColumn("record", F.coalesce(record, "carried"))
    parts = rows.groupBy("source_file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
    return parts.select("source_file", F.array_join(F.col("parts.value"), "\n").alias("value"))


def lab_rows(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """Text rows of files with a good header, columns found by their header name.

    The header table has one small row per file. Pass it stored, so that Spark
    knows its size and can leave the lines where they are. Empty lines are no rows;
    a line of blanks is one, as a plain CSV reader sees it. Only lines of files in which
    a quoted field may go on over a line's end are put in order. ``header_line`` marks
    lines that repeat the header's text, the header itself among them.
    """
    good = heads.where("header_ok").select("source_file", "names", "header", "breaks")
    options = ", ".join(f"'{k}', '{v}'" for k, v in CSV.items())
    cells = ", ".join(f"{c} STRING" for c in POSITIONS)
    plain = lines.select("source_file", "value").join(good.where("NOT breaks"), "source_file")
    broken = good.where("breaks")
    joined = with_line_breaks(lines.join(broken.select("source_file"), "source_file", "left_semi")).join(broken, "source_file")
    split = parse_once(
        plain.unionByName(joined).where("value <> ''"),
        {"cells": f"from_csv(value, '{cells}', map({options}))"},
    )
    in_order = ", ".join(f"cells.{c}" for c in POSITIONS)
    named = [f"get(array({in_order}), CAST(array_position(names, '{c}') AS INT) - 1) AS {c}" for c in LAB_COLUMNS]
    return split.selectExpr("source_file", *named, "value = header AS header_line")


def lab_file_verdicts(
    rows: DataFrame, heads: DataFrame, strict: bool = True, report_date: date | None = None
) -> DataFrame:
    """Verdict per file: its header must fit and every row be valid; no rows is valid.

    A header line that comes twice is a row with text where a number belongs.
    """
    error = F.when(~F.col("header_line"), lab_row_error(strict, report_date))
    counted = (
        typed_labs(rows)
        .select("source_file", "header_line", error.alias("row_error"))
        .groupBy("source_file")
        .agg(
            (F.count("*") - 1).alias("row_count"),
            (F.count("row_error") + F.count_if("header_line") - 1).alias("bad_rows"),
        )
    )
    none = F.lit(0).cast("long")
    return (
        heads.select("source_file", "header_ok")
        .join(counted, "source_file", "left")
        .select(
            "source_file",
            F.coalesce("row_count", none).alias("row_count"),
            F.coalesce("bad_rows", none).alias("bad_rows"),
            (F.col("header_ok") & (F.coalesce("bad_rows", none) == 0)).alias("accepted"),
            F.when(~F.col("header_ok"), "wrong_columns").when(F.col("bad_rows") > 0, "invalid_rows").alias("reason"),
        )
    )


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """All lab files at a path, at any depth; no file is opened.

    The names come from the listing that Spark makes to read the files. Its readers, that of
    whole files too, leave out those without a byte, so lengths are not at hand.
    """
    names = _lab_files(spark, path).inputFiles()
    # A file of no host is file:///x here and file:/x in the metadata of its lines.
    return spark.createDataFrame([(re.sub(r"^(\w+):///", r"\1:/", n),) for n in names], "source_file string")


def empty_files(files: DataFrame, heads: DataFrame) -> DataFrame:
    """Verdicts of files without a byte: those of an inventory that have no first line."""
    return files.join(heads.select("source_file"), "source_file", "left_anti").select(
        "source_file",
        F.lit(0).cast("long").alias("row_count"),
        F.lit(0).cast("long").alias("bad_rows"),
        F.lit(False).alias("accepted"),
        F.lit("empty_file").alias("reason"),
    )


def read_lab_archive(spark: SparkSession, folder: str, first: date, last: date) -> DataFrame:
    """Archived labs between two dates; other partitions are not opened."""
    dated = T.StructType([*LAB.fields, T.StructField("date", T.DateType())])
    return spark.read.schema(dated).parquet(folder).where(F.col("date").between(F.lit(first), F.lit(last)))
