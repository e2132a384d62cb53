"""Sequences of a fixed window, filled with lexically close documents.

A BM25 inverted index over token ids, cut in shards, finds for each seed document the
unused documents nearest to it; they fill the seed's window one after the other.
Document frequencies are those of all whole documents (one row per id of the
vocabulary). Documents are sorted by their most telling ids, so that shards hold
related ones; a partition is a stream of shards of bounded size, each indexed, packed
and dropped before the next is read, so a hot id is many shards.

A document longer than a window fills windows of its own, without a shuffle; its rest is a
seed or a neighbour like others. The neighbour that overflows a window is cut, and what is left of it seeds
the next. What is left at a partition's end is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pulsetide.llm import words as w
from pulsetide.llm.segments import Held, Known, encoded_together, segments_of
from pulsetide.session import shared_folder, store

WINDOW = 2048
END = 1
K1, B = 1.2, 0.75
#: Share of a shard's documents from which an id counts as common.
COMMON = 0.1
#: Share of a shard's indexed documents still unused, below which the others leave the index.
KEEP = 0.75
#: Neighbours of a seed that are put in order before the others.
NEAREST = 32
#: Documents, each of less than a window, that one shard of the index holds, and that one partition holds in the mean.
SHARD_DOCS, PARTITION_DOCS = 1_000, 16_000
#: Distinct segments a worker remembers.
CACHE = 2_000_000

PACKED = "part long, local long, ids binary, pieces array<struct<doc_id: long, start: long, length: long, doc_tokens: long>>"
_PIECES = pa.list_(pa.struct([(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens")]))
_ENCODED = {
    "doc_id": "long", "ids": "binary", "n_ids": "long", "row": "long", "part": "long", "own": "long", "one": "long", "two": "long", "counts": "binary"
}

#: How byte-level vocabularies write a space.
SPACE = "\u0120"

_encoders: dict[str, "Encoder"] = w.worker_cache()


class Encoder:
    """A byte-level tokenizer with the ids of the segments met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.opening = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opening[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.known = Known(CACHE, self._forget, self._learn)

    def _forget(self) -> None:
        self.held = Held()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, segments: list[bytes], solid: np.ndarray) -> None:
        """Words behind one space are encoded some in one string, as they stand in texts: an id that opens with a space tells where one begins."""
        raw, size = np.frombuffer(b"".join(segments), np.uint8), np.fromiter(map(len, segments), np.int64, len(segments))
        stop = np.cumsum(size)
        spaces = np.diff(np.searchsorted(np.flatnonzero(raw == 32), stop), prepend=0)
        spaced = (raw[stop - size] == 32) & (spaces == 1)
        self.held.add(*encoded_together(self._ids, segments, spaced & solid, b"", self.opening, last=False))

    def encode(self, texts: w.Texts, end: int) -> list[np.ndarray]:
        """Each document's ids, closed by `end`. A text that holds a special token's string is encoded whole."""
        start, stop, first = segments_of(texts, fine=True)
        flat, sums = self.held.take(self.known.places(texts.data, start, stop))
        bounds = sums[first]
        flat = np.insert(flat, bounds[1:], np.uint32(end))
        bounds = bounds + np.arange(len(bounds))
        out = [flat[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]
        raw = texts.data.tobytes()
        if any(s in raw for s in self.special):
            for i in range(len(texts)):
                text = texts.bytes(i)
                if any(s in text for s in self.special):
                    out[i] = np.array([*self._ids([text.decode("utf-8", "replace")])[0], end], np.uint32)
        return out


def encoder(path: str) -> Encoder:
    """The worker's own, which its tasks share; what other operators left goes."""
    w.keep_only(_encoders)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, vocabulary: str, folder: str, window: int, end: int = END) -> DataFrame:
    """Stored, per row of the documents: doc_id, ids (`end` last, 16 bits each where the vocabulary allows it, else 32), n_ids, row
    (a number of its own), part and own (its task, and the full windows of documents before it there), one and two.

    one and two are the ids that tell most of a document: late in the vocabulary, where
    rare ones are, and not met just once. Related documents share them. A task's last row
    holds no document but counts: in how many of its documents each id occurs (32 bits each).
    """

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base = own = 0
        tool, found = encoder(vocabulary), np.zeros(0, np.int64)
        for batch, texts in w.batches(rows):
            ids = tool.encode(texts, end)
            sizes = np.array([len(x) for x in ids], np.int64)
            row, term, times = _terms(np.concatenate(ids), sizes)
            one, two = telling(row, term, times)
            found = _added(found, np.bincount(term))
            before = own + np.cumsum(sizes // window) - sizes // window
            columns = {
                "doc_id": batch.column("doc_id"),
                "ids": pa.array([x.astype(tool.width).tobytes() for x in ids], pa.binary()),
                "n_ids": sizes,
                "row": (part << 40) + base + np.arange(len(ids)),
                "part": np.full(len(ids), part),
                "own": before,
                "one": one,
                "two": two,
                "counts": pa.nulls(len(ids), pa.binary()),
            }
            base, own = base + len(ids), own + int((sizes // window).sum())
            yield pa.RecordBatch.from_pydict(columns)
        kind = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_ids", "row", "part", "own", "one", "two")] + [("ids", pa.binary()), ("counts", pa.binary())])
        yield pa.RecordBatch.from_pylist([{"n_ids": 0, "part": part, "counts": found.astype("<u4").tobytes()}], kind).select(list(_ENCODED))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = ", ".join(f"{name} {kind}" for name, kind in _ENCODED.items())
    return _stored(rows.mapInArrow(encode, kind), folder)


def _added(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Counts by id, of which either may know fewer ids."""
    out = np.zeros(max(len(one), len(two)), np.int64)
    out[: len(one)] += one
    out[: len(two)] += two
    return out


def _stored(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch's documents end to end, and how many each has."""
    sizes, raw = batch.column("n_ids").to_numpy(), b"".join(batch.column("ids").to_pylist())
    return np.frombuffer(raw, _width(len(raw), int(sizes.sum()))), sizes


def _width(n_bytes: int, n_ids: int) -> str:
    return "<u2" if n_bytes == 2 * n_ids else "<u4"


def _terms(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, id) of some documents in that order, and how often each occurs."""
    bits = max(1, int(flat.max(initial=0)).bit_length())
    # Codes of 32 bits, where they suffice, are sorted in half the time.
    kind = np.uint32 if len(sizes) << bits <= 1 << 32 else np.int64
    codes = np.repeat(np.arange(len(sizes), dtype=kind) << kind(bits), sizes)
    codes |= flat.astype(kind, copy=False)
    codes.sort()
    new = np.ones(len(codes), bool)
    np.not_equal(codes[1:], codes[:-1], out=new[1:])
    at = np.flatnonzero(new)
    codes = codes[at].astype(np.int64)
    return codes >> bits, codes & ((1 << bits) - 1), np.diff(at, append=len(new))


def telling(row: np.ndarray, term: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each document the two ids of the highest score; the same one twice if it has no other."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    score = np.log(2.0 + term) * (times - 0.9) / (times + K1)
    found = []
    for _ in range(2):
        best = np.flatnonzero(score == np.maximum.reduceat(score, first)[row])
        at = best[np.diff(row[best], prepend=-1) > 0]
        found.append(term[at])
        score[at] = np.where(np.diff(first, append=len(row)) > 1, -1.0, score[at])
    return found[0], found[1]


def _frequencies(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(0, np.int64)
    for batch in rows:
        for raw in batch.column("counts"):
            found = _added(found, np.frombuffer(raw.as_buffer(), "<u4"))
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at])], names=["id", "df"])


def statistics(docs: DataFrame, window: int) -> tuple[np.ndarray, float, int]:
    """Over all documents: idf by id; mean length and number of what is packed. At most one row per id of the vocabulary comes back."""
    rest = F.col("n_ids") % window
    counts = docs.where("counts IS NOT NULL").select("counts")
    total = docs.where("counts IS NULL").agg(F.count("*").alias("n"), F.sum(rest).alias("ids"), F.count_if(rest > 0).alias("rests")).first()
    rows = counts.mapInArrow(_frequencies, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(int(max(rows["id"].to_pylist(), default=0)) + 1, np.int64)
    df[rows["id"].to_numpy()] = rows["df"].to_numpy()
    return np.log1p((total["n"] - df + 0.5) / (df + 0.5)), (total["ids"] or 0) / max(total["rests"], 1), total["rests"]


class Index:
    """An inverted BM25 index of one shard: of each id its documents and what it adds to their score."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.array([len(x) for x in docs], np.int64)
        row, term, times = _terms(np.concatenate(docs).astype(np.int64), sizes)
        weight = idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * sizes[row] / mean))
        # By id; the places in the low bits keep each id's documents in order.
        order = np.sort((term << 32) | np.arange(len(term))) & 0xFFFFFFFF
        self.left, self.first = np.arange(len(docs)), np.searchsorted(row, np.arange(len(docs) + 1))
        self.docs, self.weights = row[order], weight[order]
        sorted_terms = term[order]
        self.starts = np.flatnonzero(np.diff(sorted_terms, prepend=-1))
        self.stops = np.append(self.starts[1:], len(order))
        # Each document's ids, as places among the shard's.
        self.terms_of = np.zeros(len(order), np.int64)
        self.terms_of[order] = np.repeat(np.arange(len(self.starts)), self.stops - self.starts)
        # Ids that many documents hold lie in full rows, which add up faster than their postings.
        common = np.flatnonzero(self.stops - self.starts >= len(docs) * COMMON)
        self.row = np.full(len(self.starts), -1)
        self.row[common] = np.arange(len(common))
        self.full = np.zeros((len(common), len(docs)))
        row = np.repeat(self.row, self.stops - self.starts)
        held = row >= 0
        self.full[row[held], self.docs[held]] = self.weights[held]

    def keep(self, unused: np.ndarray) -> None:
        """Leave the postings of unused documents only, whose scores stay as they are."""
        held = unused[self.left]
        mask = held[self.docs]
        before = np.concatenate(([0], np.cumsum(mask)))
        self.starts, self.stops = before[self.starts], before[self.stops]
        self.docs, self.weights = (np.cumsum(held) - 1)[self.docs[mask]], self.weights[mask]
        self.left, self.full = self.left[held], np.compress(held, self.full, axis=1)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document that is left for the distinct ids of one of them."""
        at = self.terms_of[self.first[seed] : self.first[seed + 1]]
        row = self.row[at]
        at = at[row < 0]
        starts = self.starts[at]
        n = self.stops[at] - starts
        postings = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.docs[postings], self.weights[postings], len(self.left)) + self.full[row[row >= 0]].sum(axis=0)


def _best_first(scores: np.ndarray) -> Iterator[int]:
    """Places by falling score, equal ones in their order. The NEAREST are sorted first, as a window seldom takes more."""
    least = np.partition(scores, -NEAREST)[-NEAREST] if len(scores) > NEAREST else -np.inf
    near = scores >= least
    for some in (near, ~near):
        at = np.flatnonzero(some)
        yield from at[np.argsort(-scores[at], kind="stable")].tolist()


class _Packer:
    """Fills windows from one shard after the other; only an open window goes from shard to shard."""

    def __init__(self, window: int, idf: np.ndarray, mean: float):
        self.window, self.idf, self.mean = window, idf, mean
        self.ids: list[np.ndarray] = []
        self.pieces: list[dict] = []
        self.filled = 0
        self.done: list[tuple[bytes, list[dict]]] = []

    def close(self) -> None:
        if self.filled:
            self.done.append((np.concatenate(self.ids).astype("<u4").tobytes(), self.pieces))
            self.ids, self.pieces, self.filled = [], [], 0

    def add(self, doc: tuple, start: int) -> int:
        """As much of (doc_id, ids, the document's ids before these, all of its ids) from `start` as fits; returns where it stops."""
        name, ids, before, total = doc
        stop = min(len(ids), start + self.window - self.filled)
        self.ids.append(ids[start:stop])
        self.pieces.append({"doc_id": name, "start": before + start, "length": stop - start, "doc_tokens": total})
        self.filled += stop - start
        if self.filled == self.window:
            self.close()
        return stop

    def shard(self, docs: list[tuple]) -> None:
        index = Index([doc[1] for doc in docs], self.idf, self.mean) if len(docs) > 1 else None
        unused = np.ones(len(docs), bool)
        after = 0
        while after < len(docs):
            if not unused[after]:
                after += 1
                continue
            seed, start = after, 0
            unused[seed] = False
            while seed is not None:
                while start < len(docs[seed][1]):
                    start = self.add(docs[seed], start)
                if not self.filled or not unused.any():
                    break
                if np.count_nonzero(unused) < KEEP * len(index.left):
                    index.keep(unused)
                seed, start = self.neighbours(docs, index, seed, unused)

    def neighbours(self, docs: list[tuple], index: Index, seed: int, unused: np.ndarray) -> tuple[int | None, int]:
        """Fill the open window with the best unused documents; the one cut there, if any, seeds the next."""
        held = unused[index.left]
        left = index.left[held]
        for place in _best_first(index.scores(seed)[held]):
            doc = int(left[place])
            unused[doc] = False
            start = self.add(docs[doc], 0)
            if not self.filled:
                return (doc, start) if start < len(docs[doc][1]) else (None, 0)
        return None, 0

    def finish(self) -> None:
        """Cut an open window at powers of two."""
        ids, pieces = (np.concatenate(self.ids), self.pieces) if self.filled else (np.zeros(0, np.uint32), [])
        self.ids, self.pieces, self.filled = [], [], 0
        at = 0
        for piece in pieces:
            own, done = ids[at : at + piece["length"]], 0
            at += piece["length"]
            while done < len(own):
                room = 1 << ((len(ids) - at + len(own) - done + self.filled).bit_length() - 1)
                take = min(len(own) - done, room - self.filled)
                self.ids.append(own[done : done + take])
                self.pieces.append(piece | {"start": piece["start"] + done, "length": take})
                self.filled, done = self.filled + take, done + take
                if self.filled == room:
                    self.close()


def _pack(window: int, idf: Broadcast, mean: float):
    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        packer, part, local = _Packer(window, idf.value, mean), TaskContext.get().partitionId(), 0

        def sent() -> pa.RecordBatch:
            nonlocal local
            n = len(packer.done)
            raw, pieces = zip(*packer.done)
            packer.done = []
            local += n
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n), pa.array(range(local - n, local)), pa.array(raw, pa.binary()), pa.array(pieces, _PIECES)],
                names=["part", "local", "ids", "pieces"],
            )

        held = []
        for batch in rows:
            flat, sizes = _flat(batch)
            ends = np.cumsum(sizes)
            names, totals = batch.column("doc_id").to_pylist(), batch.column("total").to_pylist()
            for name, total, end, n in zip(names, totals, ends.tolist(), sizes.tolist()):
                held.append((name, flat[end - n : end].astype("<u4"), total - n, total))
                if len(held) == SHARD_DOCS:
                    packer.shard(held)
                    held = []
                    if packer.done:
                        yield sent()
        if held:
            packer.shard(held)
        packer.finish()
        if packer.done:
            yield sent()

    return pack


def _own_windows(window: int):
    """The full windows that long documents fill alone."""

    def own(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            flat, sizes = _flat(batch)
            starts = np.cumsum(sizes) - sizes
            names, parts, before = (batch.column(c).to_pylist() for c in ("doc_id", "part", "own"))
            out: dict[str, list] = {"part": [], "local": [], "ids": [], "pieces": []}
            for name, part, local, at, n in zip(names, parts, before, starts.tolist(), sizes.tolist()):
                for k in range(n // window):
                    out["part"].append(part)
                    out["local"].append(local + k)
                    out["ids"].append(flat[at + k * window : at + (k + 1) * window].astype("<u4").tobytes())
                    out["pieces"].append([{"doc_id": name, "start": k * window, "length": window, "doc_tokens": n}])
            kinds = [pa.int64(), pa.int64(), pa.binary(), _PIECES]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return own


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end: int = END, folder: str | None = None) -> DataFrame:
    """Sequences of at most `window` ids: sequence_id, ids, pieces.

    ids are unsigned 32-bit little-endian, end to end; pieces tell in order whose they are:
    doc_id, start (the document's ids before the piece), length, doc_tokens (all of the
    document's ids, `end` included). Every id of every document lies in one piece.
    Sequences hold `window` ids, but for the last of a partition, which are cut at powers
    of two. A null or empty text is its end id alone. Rows of one doc_id, or without
    one, are documents of their own; equal ones are neighbours. An empty table gives
    none. sequence_id counts from 0 without gaps. Other columns are not read.
    `vocabulary` is a byte-level tokenizer file that every executor has.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "packing")
    rows = encoded(docs, vocabulary, f"{folder}/ids", window, end)
    telling_ids, mean, n = statistics(rows, window)
    idf = spark.sparkContext.broadcast(telling_ids)
    rest = F.expr(f"substring(ids, cast((n_ids - n_ids % {window}) * (length(ids) div n_ids) + 1 as int))").alias("ids")
    rests = rows.where(f"n_ids % {window} > 0").select("doc_id", rest, (F.col("n_ids") % window).alias("n_ids"), F.col("n_ids").alias("total"), "one", "two", "row")
    # The row's number parts copies, so that no group of them is one partition.
    near = rests.repartitionByRange(max(1, -(-n // PARTITION_DOCS)), "one", "two", "row").sortWithinPartitions("one", "two", "row")
    packed = _stored(near.mapInArrow(_pack(window, idf, mean), PACKED), f"{folder}/packed").withColumn("kind", F.lit(1))
    long = rows.where(F.col("n_ids") >= window)
    own = long.select("doc_id", "ids", "n_ids", "part", "own").mapInArrow(_own_windows(window), PACKED).withColumn("kind", F.lit(0))
    # One row per task: their prefix sums number the sequences.
    counts = long.groupBy("part").agg(F.sum(F.expr(f"n_ids div {window}")).alias("n")).withColumn("kind", F.lit(0))
    counts = counts.unionByName(packed.groupBy("part", "kind").agg(F.count("*").alias("n")))
    before = Window.orderBy("kind", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = store(counts.select("kind", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), f"{folder}/bases")
    sequences = packed.unionByName(own).join(bases, ["kind", "part"])
    return sequences.select((F.col("base") + F.col("local")).alias("sequence_id"), "ids", "pieces")


def pieces_of(sequences: DataFrame) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, and its ids."""
    rows = sequences.withColumn("before", F.expr("transform(pieces, (x, i) -> aggregate(slice(pieces, 1, i), 0L, (a, y) -> a + y.length))"))
    rows = rows.select("sequence_id", "ids", F.explode(F.arrays_zip("pieces", F.col("before").alias("offset"))).alias("p"))
    rows = rows.select("p.pieces.*", "sequence_id", "p.offset", "ids")
    return rows.withColumn("ids", F.expr("substring(ids, cast(4 * offset + 1 as int), cast(4 * length as int))"))
