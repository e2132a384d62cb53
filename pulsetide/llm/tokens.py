"""Token ids as flat binary shards that training reads by memory map.

A shard holds a range of doc_ids in ascending order, in three files:
  NAME.ids      the ids of all its documents end to end, unsigned little-endian,
                16 bits where the vocabulary allows it, else 32
  NAME.offsets  64-bit: where each document starts in this shard, and the end
  NAME.docs     64-bit: the documents' doc_ids (the least value stands for null)
The manifest has a row per shard with its counts and its base, the number of ids in
all shards before it: the prefix sum of the counts. base + offset is a document's
place in the whole corpus.

Text is encoded piece by piece: white space always parts the vocabulary's words, and
so does a border between an ASCII letter and another ASCII character that is no
apostrophe. Each distinct piece is encoded once per worker and slice.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulsetide.llm import files, words as w
from pulsetide.llm.segments import Held, Known, encoded_together
from pulsetide.session import batches_of, shared_folder, store

END = 2
NO_ID = -(1 << 63)
#: Distinct pieces that a worker remembers (about 40 bytes each).
CACHE = 2_000_000
#: Bytes of text that are worked on at once (which takes some forty times as much), and rows that a worker gets at once.
SLICE_BYTES, BATCH_ROWS = 1 << 18, 1_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_OTHER = np.zeros(256, bool)
_OTHER[:128] = True
_OTHER &= ~_LETTER & w.SPACED
_OTHER[39] = False

_encoders: dict[str, "Encoder"] = w.worker_cache()


class Encoder:
    """A tokenizer file with the ids of the pieces met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.known = Known(CACHE, self._forget, self._learn)

    def _forget(self) -> None:
        self.held = Held()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes], solid: np.ndarray) -> None:
        """Pieces of letters are encoded some in one string: white space parts them, and an id that closes a word tells where one ends."""
        worded = [p.isalpha() or p.decode("utf-8", "replace").isalpha() for p in pieces]
        worded = np.array(worded, bool) & self.closing.any()
        self.held.add(*encoded_together(self._ids, pieces, worded, b" ", self.closing, last=True))

    def encode(self, texts: w.Texts, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents end to end, each closed by `end`, and their counts."""
        start, stop, first = pieces_of(texts)
        plain = texts.data
        # Lower-casing is the vocabulary's own first step; doing it here for ASCII pieces makes fewer of them distinct.
        upper = np.flatnonzero(_UPPER[plain])
        if len(upper):
            mixed = np.zeros(len(start), bool)
            mixed[np.searchsorted(start, np.flatnonzero(plain >= 128), "right") - 1] = True
            upper = upper[~mixed[np.searchsorted(start, upper, "right") - 1]]
            plain = plain.copy()
            plain[upper] += 32
        flat, sums = self.held.take(self.known.places(plain, start, stop))
        bounds = sums[first]
        counts = np.diff(bounds)
        whole = [i for i in range(len(texts)) if self._special(texts, i)] if self._any_special(texts) else []
        if whole:
            parts = [flat[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
            for i in whole:
                text = texts.bytes(i).decode("utf-8", "replace")
                parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            flat = np.concatenate(parts)
        return np.insert(flat, np.cumsum(counts), np.uint32(end)), counts + 1

    def _any_special(self, texts: w.Texts) -> bool:
        raw = texts.data.tobytes()
        return any(s in raw for s in self.special)

    def _special(self, texts: w.Texts, i: int) -> bool:
        raw = texts.bytes(i)
        return any(s in raw for s in self.special)


def pieces_of(texts: w.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each piece, and of document i the pieces first[i]:first[i + 1]."""
    data, n = texts.data, len(texts.data)
    inside, letter, other = w.SPACED[data], _LETTER[data], _OTHER[data]
    # Whether a piece may not go on over each byte's start.
    cut = np.zeros(n + 1, bool)
    cut[1:-1] = (letter[:-1] & other[1:]) | (other[:-1] & letter[1:]) | ~(inside[:-1] & inside[1:])
    cut[texts.offsets] = True
    start = np.flatnonzero(inside & cut[:-1])
    stop = np.flatnonzero(inside & cut[1:]) + 1
    return start, stop, np.searchsorted(start, texts.offsets)


def encoder(path: str) -> Encoder:
    """The worker's own, which its tasks share; what other operators left goes."""
    w.keep_only(_encoders)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
        w.give_back()
    return _encoders[path]


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end: int = END) -> DataFrame:
    """Write the documents' ids below `folder`; returns the manifest.

    `vocabulary` is a path that every executor has. Null text is empty: only the
    end id. Repeated ids are ordered by text, a null doc_id comes first. An empty
    table writes no shard. Other columns are not read.
    """
    files.make_folder(folder)

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(vocabulary)
        name = f"{folder}/shard-{TaskContext.get().partitionId():06d}"
        ids, counts, n = [], [], 0
        with files.Writing(f"{name}.ids") as out:
            for batch, texts in w.batches(rows, most=SLICE_BYTES):
                flat, sizes = tokenizer.encode(texts, end)
                out.write(flat.astype(tokenizer.width).tobytes())
                counts.append(sizes)
                ids.append(batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False))
        if not counts:
            return
        sizes = np.concatenate(counts)
        n = len(sizes)
        with files.Writing(f"{name}.offsets") as out:
            out.write(np.concatenate(([0], np.cumsum(sizes))).astype("<i8").tobytes())
        with files.Writing(f"{name}.docs") as out:
            out.write(np.concatenate(ids).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict(
            {"shard": [TaskContext.get().partitionId()], "name": [name], "kind": [tokenizer.width], "n_docs": [n], "n_ids": [int(sizes.sum())]}
        )

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shards = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    with batches_of(docs.sparkSession, BATCH_ROWS):
        written = store(shards.mapInArrow(write, "shard long, name string, kind string, n_docs long, n_ids long"), f"{folder}/shards")
    # One row per shard: their prefix sums are the shards' bases.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = written.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return store(based, f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def shard_documents(name: str, kind: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, offset, ids) of each document of a shard."""
    ids = files.mapped(f"{name}.ids", kind)
    offsets = files.mapped(f"{name}.offsets", "<i8")
    for doc, lo, hi in zip(files.mapped(f"{name}.docs", "<i8").tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        yield doc, lo, ids[lo:hi]


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for shard in batch.to_pylist():
                out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                for doc, offset, ids in shard_documents(shard["name"], shard["kind"]):
                    out["doc_id"].append(None if doc == NO_ID else doc)
                    out["start"].append(shard["base"] + offset)
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], names=list(out))

    shards = max(1, manifest.count())
    spread = manifest.repartition(min(shards, 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, vocabulary: str, folder: str | None = None, end: int = END) -> DataFrame:
    """Write the documents' ids and read them back."""
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, vocabulary, folder, end))
