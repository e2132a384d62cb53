"""The registered query of each operator: (spark, folder of the tables) -> its digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsetide.llm import align, decontaminate, langid, middle, mix, near_dup, packing, quality, secrets, substrings, suffixes, tokens, warc
from pulsetide.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    rows = secrets.find_secrets(table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path(RANKS))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op2_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_documents(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))


def op4_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_bytes(table(spark, folder, "documents")).drop("kept")


def op5_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_words(table(spark, folder, "documents")).drop("kept")


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = mix.mix(table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.write_and_read(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, folder, "benchmark")).drop("text")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.judge(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    shared = shared_folder(spark, "align")
    paths = public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES)
    links = align.aligned(table(spark, folder, "documents"), *paths, f"{shared}/aligned")
    names = align.counted(links, shared)
    # The groups' texts are digested where they are read, so the pass over the links does not carry them.
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align.scored(links.withColumn("groups_sha256", digest).drop("groups"), names)


def op12_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = middle.fill_in_middle(table(spark, folder, "documents"))
    restored = middle.restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pieces_of(packing.pack(table(spark, folder, "documents"), public_tokenizers.path(BYTE_LEVEL)))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def all_queries() -> dict[str, Query]:
    return {
        name: query
        for name, query in globals().items()
        if name.startswith("op") and name[2:].split("_")[0].isdigit()
    }
