"""Runs: documents packed once into rows of some megabytes, which later passes read without a shuffle.

A pass over runs sends sorted fingerprints or suffixes to parts, one row per run
and part; a part answers each run it heard from; a run's answers lie in a file
named after it. So a fingerprint that a third of all documents hold reaches a
part once per run, and no task holds more than a run or a part. Files are written
whole or not at all and hold the same bytes when a lost task runs again.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pulsetide.llm import files, words as w
from pulsetide.session import store

RUN_BYTES = 8 << 20
#: Fingerprints that one part merges.
PART_VALUES = 2_000_000

SENT = "part long, run long, payload binary"


def _blob(rows: list[pa.RecordBatch]) -> bytes:
    table = pa.Table.from_batches(rows)
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return out.getvalue()


def _blobs(rows: Iterator[pa.RecordBatch], run_bytes: int) -> Iterator[tuple[int, bytes]]:
    """(run, blob) of a task's documents."""
    base, seq, held, size = TaskContext.get().partitionId() << 24, 0, [], 0
    for batch, texts in w.batches(rows, "text"):
        if held and size + len(texts.data) > run_bytes:
            yield base + seq, _blob(held)
            seq, held, size = seq + 1, [], 0
        held.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), w.column(batch.column("text"))], names=["doc_id", "text"]))
        size += len(texts.data)
    if held:
        yield base + seq, _blob(held)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def pack(docs: DataFrame, folder: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Stored rows (run, blob): doc_id and text (null as empty) of whole documents, at most `run_bytes` or one document."""

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, blob in _blobs(rows, run_bytes):
            yield pa.RecordBatch.from_pydict({"run": [run], "blob": [blob]})

    return store(_documents(docs).mapInArrow(packed, "run long, blob binary"), f"{folder}/runs")


def pack_files(docs: DataFrame, folder: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The same with a run's blob in a file of its own, so that passes over runs move nothing of it through the JVM.

    Stored rows (run, file, n_bytes). A file's name is its task attempt's, so a run's is the one of the attempt that counts.
    """
    files.make_folder(f"{folder}/blobs")

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = uuid.uuid4().hex
        for run, blob in _blobs(rows, run_bytes):
            uri = f"{folder}/blobs/{run}-{attempt}"
            with files.Writing(uri) as out:
                out.write(blob)
            yield pa.RecordBatch.from_pydict({"run": [run], "file": [uri], "n_bytes": [len(blob)]})

    return store(_documents(docs).mapInArrow(packed, "run long, file string, n_bytes long"), f"{folder}/runs")


def opened(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, w.Texts]]:
    """(run, doc_ids, texts) of each run."""
    for batch in rows:
        for run, raw in zip(batch.column("run").to_pylist(), batch.column("blob")):
            yield run, *_parts(raw.as_buffer())


def opened_files(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, w.Texts]]:
    """The same of runs in files."""
    for batch in rows:
        for run, uri in zip(batch.column("run").to_pylist(), batch.column("file").to_pylist()):
            yield run, *_parts(pa.py_buffer(files.whole(uri)))


def _parts(raw: pa.Buffer) -> tuple[pa.Array, w.Texts]:
    table = pa.ipc.open_stream(pa.BufferReader(raw)).read_all().combine_chunks()
    return table["doc_id"].combine_chunks(), w.texts_of(table["text"].cast(pa.large_string(), safe=False))


def save(uri: str, **arrays: np.ndarray) -> None:
    with files.Writing(uri) as out:
        buffer = io.BytesIO()
        np.savez(buffer, **arrays)
        out.write(pa.compress(buffer.getvalue(), "zstd", asbytes=True) + np.array([buffer.tell()], "<i8").tobytes())


def load(uri: str) -> dict[str, np.ndarray]:
    raw = files.whole(uri)
    size = int(np.frombuffer(raw[-8:], "<i8")[0])
    return dict(np.load(io.BytesIO(pa.decompress(raw[:-8], size, "zstd", asbytes=True)), allow_pickle=False))


def planes(values: np.ndarray, width: int) -> bytes:
    """Little-endian values as planes of bytes, compressed."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return pa.compress(raw, "zstd", asbytes=True)


def unplanes(raw: bytes, n: int, width: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(raw, n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = flat.T
    return out.view("<u8").ravel()


def send_values(run: int, values: np.ndarray, checks: np.ndarray | None, many: np.ndarray, bits: int, parts: int) -> pa.RecordBatch:
    """A run's distinct sorted fingerprints of `bits` bits, cut by range into parts.

    checks: 32 more bits of each; many: found more than once in this run.
    """
    part = ((values >> np.uint64(max(0, bits - 32))) * np.uint64(parts)) >> np.uint64(min(bits, 32))
    bounds = np.searchsorted(part, np.arange(parts + 1))
    rows: dict[str, list] = {"part": [], "run": [], "payload": []}
    for p in range(parts):
        lo, hi = bounds[p], bounds[p + 1]
        if lo < hi:
            steps = np.diff(values[lo:hi], prepend=np.uint64(0))
            width = (max(int(steps.max()).bit_length(), 1) + 7) // 8
            out = io.BytesIO()
            pieces = [planes(steps, width), np.packbits(many[lo:hi]).tobytes(), planes(checks[lo:hi], 4) if checks is not None else b""]
            out.write(np.array([hi - lo, width, *map(len, pieces)], "<i8").tobytes() + b"".join(pieces))
            rows["part"].append(p)
            rows["run"].append(run)
            rows["payload"].append(out.getvalue())
    return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int64()), ("run", pa.int64()), ("payload", pa.binary())]))


def _received(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, width, a, b, c = np.frombuffer(raw[:40], "<i8").tolist()
    values = np.cumsum(unplanes(raw[40 : 40 + a], n, width))
    many = np.unpackbits(np.frombuffer(raw[40 + a : 40 + a + b], np.uint8), count=n).astype(bool)
    checks = unplanes(raw[40 + a + b :], n, 4).astype(np.uint32) if c else np.zeros(n, np.uint32)
    return values, checks, many


def _answer(table: pa.Table) -> pa.Table:
    """A part's answers: for each run, a bit per fingerprint it sent, set where it is found anywhere else."""
    part = table["part"][0].as_py()
    runs = table["run"].to_pylist()
    got = [_received(x) for x in table["payload"].to_pylist()]
    values, checks, many = (np.concatenate(x) for x in zip(*got))
    order = np.lexsort((checks, values)) if checks.any() else np.argsort(values, kind="stable")
    v, c = values[order], checks[order]
    same = (v[1:] == v[:-1]) & (c[1:] == c[:-1])
    found = np.zeros(len(v), bool)
    found[1:] |= same
    found[:-1] |= same
    out = np.empty(len(v), bool)
    out[order] = found
    out |= many
    bounds = np.cumsum([0, *(len(x[0]) for x in got)])
    answers = [np.packbits(out[lo:hi]).tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])]
    return pa.table(
        {"run": pa.array(runs, pa.int64()), "part": pa.array([part] * len(runs), pa.int64()), "n": pa.array(np.diff(bounds), pa.int64()), "payload": pa.array(answers, pa.binary())}
    )


def exchange(sent: DataFrame, folder: str, answer: Callable[[pa.Table], pa.Table] = _answer) -> int:
    """Merge what runs sent, part by part; each run's answers go to FOLDER/RUN, in order of its parts. Returns the values sent."""
    files.make_folder(folder)

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        run = table["run"][0].as_py()
        n = np.array(table["n"].to_pylist(), np.int64)
        payload = table["payload"].to_pylist()
        save(f"{folder}/{run}", n=n, size=np.array([len(x) for x in payload], np.int64), payload=np.frombuffer(b"".join(payload), np.uint8))
        return pa.table({"run": pa.array([run], pa.int64()), "n": pa.array([int(n.sum())], pa.int64())})

    answers = sent.groupBy("part").applyInArrow(answer, "run long, part long, n long, payload binary")
    done = store(answers.groupBy("run").applyInArrow(write, "run long, n long"), f"{folder}-done")
    return done.agg(F.sum("n")).first()[0] or 0


def answered(folder: str, run: int, n: int) -> np.ndarray:
    """The bits that came back for the n fingerprints a run sent."""
    if not n:
        return np.zeros(0, bool)
    got = load(f"{folder}/{run}")
    ends = np.cumsum(got["size"])
    bits = [np.unpackbits(got["payload"][e - s : e], count=k) for s, e, k in zip(got["size"], ends, got["n"])]
    return np.concatenate(bits).astype(bool)
