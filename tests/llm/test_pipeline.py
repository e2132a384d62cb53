"""The pipeline's stages over the smallest tables, and the queries' SQL."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from checks.compare import difference, duck
from pulsetide.llm import oracles, queries
from pulsetide.session import BATCH


def test_stages_keep_the_documents_columns(spark, sf, tmp_path):
    docs = queries.table(spark, sf, "documents")
    before, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "token_files":
            assert after.columns == docs.columns
            assert after.select("doc_id").distinct().join(before, "doc_id", "left_anti").isEmpty()
            before = after
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    at, expected = 0, []
    for doc, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(tuple(r) for r in after.select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(expected)


def test_stages_send_python_small_batches(spark, sf, monkeypatch):
    """a task's JVM and worker held 10,000 documents at once."""

    def sizes(docs, *_):
        return docs.mapInArrow(lambda rows: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in rows), "n long")

    before = spark.conf.get(BATCH)
    docs = spark.range(2_500).selectExpr("id AS doc_id", "'a b' AS text").coalesce(1)
    for module, operator in (("langid", "known_documents"), ("near_dup", "keep_one"), ("decontaminate", "clean_documents")):
        monkeypatch.setattr(getattr(corpus_pipeline, module), operator, sizes)
    try:
        for _, stage in corpus_pipeline.STAGES[:3]:
            spark.conf.set(BATCH, before)
            assert sorted(r["n"] for r in stage(spark, docs, sf).collect()) == [500, 1_000, 1_000]
    finally:
        spark.conf.set(BATCH, before)


@pytest.mark.parametrize("name", sorted(oracles.all_oracles()))
def test_sql(spark, sf, name, monkeypatch):
    monkeypatch.setattr("checks.compare.all_oracles", oracles.all_oracles)
    assert difference(duck(sf), name, queries.all_queries()[name](spark, sf)) is None
