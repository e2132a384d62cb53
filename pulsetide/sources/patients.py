"""Patient reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsetide.params import PATIENT_COLUMNS
from pulsetide.schemas import PATIENT


def read_patients(spark: SparkSession, path: str) -> DataFrame:
    """Patients of a CSV file that has at least the three columns."""
    rows = spark.read.option("header", True).csv(path)
    missing = [c for c in PATIENT_COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"patient CSV lacks {missing}")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PATIENT.fields])
