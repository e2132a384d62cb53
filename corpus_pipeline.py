"""A training corpus from the documents: five stages, each over all that the one before kept.

language ID -> near duplicates -> decontamination -> mixing -> token files.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from pulsetide.llm import decontaminate, langid, mix, near_dup, tokens  # noqa: E402
from pulsetide.llm.queries import VOCABULARY, table  # noqa: E402
from pulsetide.session import batches_of, shared_folder, store, use_batches_of  # noqa: E402

#: A text whose language scores less is rejected like one of no language.
LEAST_SCORE = 0.3
#: Documents that a Python task gets at once. A stage leaves the session so: its rows are computed when they are written.
BATCH_ROWS = 1_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_batches_of(spark, BATCH_ROWS)
    return langid.known_documents(docs, LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_batches_of(spark, BATCH_ROWS)
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_batches_of(spark, BATCH_ROWS)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: A trained network, a tokenizer and a similarity join are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written before the next reads them."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    with batches_of(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = store(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
