"""Alignment of two tokenizers' tokens over the same text, and how often their ids meet.

Tokenizer A is a byte-level vocabulary of the tokenizers library, B a sentencepiece
model with byte fallback that sets a space before the text; A gets that space too.
Where a token covers whole characters, its character offsets (A, made bytes by the
sparse index of `chars`) or the piece's span in the encoding's proto (B) say where it
ends. These are the coarse cuts. Tokens that share a character have spans that
overlap or are empty: their ends are counted on from the cut before by the length
of their decoded bytes. Groups are cut where an A and a B token end at the same
byte; between two neighbouring ends of either kind lies exactly one link.

Both vocabularies work segment by segment (see `segments`), so each distinct segment is
aligned once per worker. The aligned documents are stored; id pairs are counted from
them, combined in each task before they are shuffled; the counted pairs become
sorted files of bounded size, which tasks read one by one to score each document's links.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pulsetide.llm import files, words as w
from pulsetide.llm.chars import Exceptions
from pulsetide.llm.segments import Known, room, segments_of
from pulsetide.session import shared_folder, store

#: Distinct segments a worker remembers (about 150 bytes each), and distinct pairs a task counts before it sends them.
CACHE, COUNTED = 1_000_000, 1_000_000
#: Bytes of whole documents aligned at once, and of segments encoded as one string.
SLICE, JOINED = 1 << 20, 32 << 10
#: Pairs in one file of the counts (17 bytes each).
FILE_PAIRS = 2_000_000
#: Links scored at once, in whole documents.
SCORED = 500_000

ALIGNED = "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"

_aligners: dict[tuple[str, str], "Aligner"] = w.worker_cache()
_PIECE = attrgetter("id", "begin", "end")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary's entries stands for.

    Printable bytes stand for themselves, the others, in order, for 256 and up.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_entries(tokenizer) -> list[bytes]:
    """Decoded bytes of a byte-level vocabulary's entries, by id."""
    alphabet, vocabulary = byte_alphabet(), tokenizer.get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        out[i] = bytes(map(alphabet.__getitem__, entry)) if all(c in alphabet for c in entry) else entry.encode()
    return out


def piece_entries(model) -> list[bytes]:
    """Bytes of a sentencepiece model's pieces, by id."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def refined_ends(first: np.ndarray, last: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where tokens end, in bytes, from their spans' borders and their decoded bytes' lengths.

    A span as long as its token's bytes is a coarse cut. From one to the next, tokens that
    share a character are laid end to end.
    """
    sums = np.cumsum(sizes)
    settled = np.maximum.accumulate(np.where(last - first == sizes, np.arange(len(sizes)), -1))
    cut = np.where(settled >= 0, last[settled], 0)
    return cut + sums - np.where(settled >= 0, sums[settled], 0)


class Digits:
    """Numbers below n in decimal digits, as bytes."""

    def __init__(self, n: int):
        shown = np.array([str(i) for i in range(n)], bytes)
        self.table = np.zeros((n, shown.itemsize + 1), np.uint8)
        self.table[:, :-1] = shown.view(np.uint8).reshape(n, -1)
        self.size = np.char.str_len(shown)

    def closed(self, numbers: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row of bytes for each number, with a byte behind its digits; and how many of them count."""
        rows, size = self.table[numbers], self.size[numbers]
        rows[np.arange(len(rows)), size] = by
        return rows, size + 1


@dataclass
class Spans:
    """Tokens of one text: ids and ends in bytes; whether their bytes are the text's."""

    ids: np.ndarray
    ends: np.ndarray
    faithful: bool


class Aligner:
    """Both tokenizers, with the alignment of the segments met so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.entries_a, self.entries_b = byte_entries(self.a), piece_entries(self.b)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in e], np.int64) for e in (self.entries_a, self.entries_b))
        self.apart = not any(" " in e.decode("utf-8", "replace").lstrip(" ") for e in self.entries_b)
        self.narrow = max(len(self.entries_a), len(self.entries_b)) <= 1 << 16
        self.digits = Digits(max(len(self.entries_a), len(self.entries_b)))
        self.known = Known(CACHE, self._forget, self._learn)

    def spans_a(self, text: str, raw: bytes) -> Spans:
        got = self.a.encode(text, add_special_tokens=False)
        ids = np.array(got.ids, np.int64)
        index = Exceptions(np.frombuffer(raw, np.uint8))
        borders = index.bytes(np.fromiter(chain.from_iterable(got.offsets), np.int64, 2 * len(ids)).reshape(-1, 2))
        faithful = b"".join(map(self.entries_a.__getitem__, got.ids)) == raw
        return Spans(ids, refined_ends(borders[:, 0], borders[:, 1], self.sizes_a[ids]), faithful)

    def spans_b(self, text: str, raw: bytes) -> Spans:
        """The first character of the text is the space that the model sets itself."""
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        ids, first, last = np.fromiter(chain.from_iterable(map(_PIECE, pieces)), np.int64, 3 * len(pieces)).reshape(-1, 3).T
        begins = first + 1
        begins[:1] = 0
        faithful = b"".join(map(self.entries_b.__getitem__, ids.tolist())) == raw
        return Spans(ids, refined_ends(begins, last + 1, self.sizes_b[ids]), faithful)

    def _forget(self) -> None:
        self.n = self.n_links = 0
        self.groups: list[bytes] = []
        #: Of each segment: n_a, n_b, n_groups, n_links (-1: its bytes are not kept), and where its links start.
        self.counts = np.zeros((1 << 12, 4), np.int64)
        self.at = np.zeros(1 << 12, np.int64)
        self.links = np.zeros(1 << 14, np.uint32 if self.narrow else np.uint64)

    def _learn(self, segments: list[bytes], solid: np.ndarray) -> None:
        """Segments that end in no white space are encoded end to end; if that fails, or they don't, one by one."""
        first, self.n = self.n, self.n + len(segments)
        self.counts, self.at = room(self.counts, self.n), room(self.at, self.n)
        self.groups += [b""] * len(segments)
        size, batch = 0, []
        for i, (raw, joins) in enumerate(zip(segments, solid.tolist())):
            if joins and self.apart and len(raw) < JOINED:
                batch.append(i)
                size += len(raw)
                if size >= JOINED:
                    self._align(segments, batch, first)
                    size, batch = 0, []
            else:
                self._align(segments, [i], first)
        self._align(segments, batch, first)

    def _align(self, segments: list[bytes], which: list[int], first: int) -> None:
        if not which:
            return
        raw = b"".join([segments[i] for i in which])
        text = raw.decode("utf-8", "replace")
        a, b = self.spans_a(text, raw), self.spans_b(text, raw)
        if not (a.faithful and b.faithful):
            if len(which) == 1:
                self.counts[first + which[0]] = (0, 0, 0, -1)
            else:
                for i in which:
                    self._align(segments, [i], first)
            return
        ends = np.sort(np.concatenate((a.ends, b.ends)), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]
        in_a, in_b = np.searchsorted(a.ends, ends), np.searchsorted(b.ends, ends)
        common = np.flatnonzero((a.ends[in_a] == ends) & (b.ends[in_b] == ends))
        # A group ends at each common end: its last token of either kind.
        last_a, last_b = in_a[common] + 1, in_b[common] + 1
        shown, shown_to = self._shown(a.ids[: last_a[-1]], b.ids[: last_b[-1]], last_a, last_b)
        bounds = np.cumsum([len(segments[i]) for i in which])
        places = [np.searchsorted(e, bounds, "right") for e in (a.ends, b.ends, ends[common], ends)]
        ends_at = np.stack(places, axis=1)
        starts_at = np.concatenate((np.zeros((1, 4), np.int64), ends_at[:-1]))
        at = first + np.array(which)
        self.counts[at] = ends_at - starts_at
        self.at[at] = self.n_links + starts_at[:, 3]
        self.links = room(self.links, self.n_links + len(ends))
        self.links[self.n_links : self.n_links + len(ends)] = (a.ids[in_a] << (16 if self.narrow else 32)) | b.ids[in_b]
        self.n_links += len(ends)
        stop = shown_to[ends_at[:, 2]]
        for i, lo, hi in zip(at.tolist(), [0, *stop[:-1].tolist()], stop.tolist()):
            # Without the byte that parts the groups of one segment from those of the next.
            self.groups[i] = shown[lo : hi - 1]

    def _shown(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Groups in order as 'a1,a2|b1;', given where the ids of each one end; and where in that each starts, and the end."""
        rows, size = np.zeros((len(a) + len(b), self.digits.table.shape[1]), np.uint8), np.zeros(len(a) + len(b), np.int64)
        for ids, last, others, close in ((a, last_a, np.append(0, last_b), b"|"), (b, last_b, np.append(last_a, 0), b";")):
            by = np.full(len(ids), ord(","), np.uint8)
            by[last - 1] = ord(close)
            # A group's ids of A stand behind those of B in the groups before, its ids of B behind its own of A.
            at = np.arange(len(ids)) + np.repeat(others[: len(last)], np.diff(last, prepend=0))
            rows[at], size[at] = self.digits.closed(ids, by)
        sums = np.append(0, np.cumsum(size))
        return rows[np.arange(rows.shape[1]) < size[:, None]].tobytes(), sums[np.append(0, last_a + last_b)]

    def align(self, texts: w.Texts) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Per document: n_a, n_b, n_groups, n_links and the groups; and the links of all documents end to end."""
        size = np.diff(texts.offsets)
        spaced = w.Texts(
            np.insert(texts.data, texts.offsets[:-1][size > 0], 32), texts.offsets + np.concatenate(([0], np.cumsum(size > 0)))
        )
        start, stop, first = segments_of(spaced) if self.apart else _whole(spaced)
        place = self.known.places(spaced.data, start, stop)
        counts = self.counts[place]
        bad = w.per_document(counts[:, 3] < 0, first) > 0
        lost = np.repeat(bad, np.diff(first))
        counts[lost] = 0
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(counts, axis=0)))
        per = sums[first[1:]] - sums[first[:-1]]
        held = place.tolist()
        groups = [b"" if b else b";".join([self.groups[p] for p in held[lo:hi]]) for b, lo, hi in zip(bad, first[:-1].tolist(), first[1:].tolist())]
        n = counts[:, 3]
        flat = self.links[np.repeat(self.at[place] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return per, groups, flat


def _whole(texts: w.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    return start, np.append(start[1:], len(texts.data)) if len(start) else start, np.searchsorted(start, texts.offsets)


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's own, which its tasks share; what other operators left goes."""
    w.keep_only(_aligners)
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def aligned(docs: DataFrame, path_a: str, path_b: str, folder: str) -> DataFrame:
    """Stored, per row of the documents: doc_id, n_a, n_b, n_groups, n_links, groups, and the links as codes of an A and a B id.

    A code takes 32 bits where both vocabularies have at most 65,536 ids, else 64; half of it is the B id.
    """

    def rows_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for batch, texts in w.batches(rows, most=SLICE):
            per, groups, flat = tool.align(texts)
            raw, size = flat.tobytes(), flat.itemsize
            ends = np.cumsum(per[:, 3])
            links = [raw[size * (e - n) : size * e] for e, n in zip(ends.tolist(), per[:, 3].tolist())]
            columns = [pa.array(groups, pa.binary()).cast(pa.string()), pa.array(links, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(per[:, i]) for i in range(4)), *columns],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
            )

    kind = ALIGNED.format(id=docs.schema["doc_id"].dataType.simpleString())
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(rows_of, kind)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Links of a batch end to end, and how many each row has."""
    raw, n = b"".join(batch.column("links").to_pylist()), batch.column("n_links").to_numpy()
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * int(n.sum()) else "<u8"), n


def _wide(codes: np.ndarray) -> np.ndarray:
    """Codes with 32 bits for either id."""
    if codes.dtype.itemsize == 8:
        return codes
    return (codes >> 16).astype(np.uint64) << np.uint64(32) | (codes & 0xFFFF).astype(np.uint64)


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's distinct pairs and how often each occurs; sent early if they are many."""
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def sent() -> pa.RecordBatch:
        a, b = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
        return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(counts)], names=["a", "b", "n"])

    for batch in rows:
        for lo in range(0, batch.num_rows, 1000):
            new, n = np.unique(_codes(batch.slice(lo, 1000))[0], return_counts=True)
            codes, back = np.unique(np.concatenate((codes, _wide(new))), return_inverse=True)
            counts = np.bincount(back, np.concatenate((counts, n)), len(codes)).astype(np.int64)
            if len(codes) > COUNTED:
                yield sent()
                codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    yield sent()


def pair_counts(links: DataFrame) -> DataFrame:
    """Per id pair that is linked anywhere: a, b, n (links that hold it), best (n is the highest of its b, ties included)."""
    pairs = links.select("links", "n_links").mapInArrow(_count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def write_counts(pairs: DataFrame, folder: str, n_pairs: int) -> list[str]:
    """Counted pairs as sorted flat files, each of about FILE_PAIRS: NAME.codes, NAME.counts, NAME.best."""
    files.make_folder(folder)

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = pa.Table.from_batches(rows) if (rows := list(rows)) else None
        if table is None or not table.num_rows:
            return
        name = f"{folder}/pairs-{TaskContext.get().partitionId():06d}"
        a, b, n = (table.column(c).to_numpy().astype(np.uint64) for c in ("a", "b", "n"))
        codes = (a << np.uint64(32)) | b
        order = np.argsort(codes)
        best = table.column("best").to_numpy().astype(np.uint8)
        for kind, values in (("codes", codes.astype("<u8")), ("counts", n.astype("<i8")), ("best", best)):
            with files.Writing(f"{name}.{kind}") as out:
                out.write(values[order].tobytes())
        yield pa.RecordBatch.from_pydict({"name": [name]})

    spread = pairs.repartitionByRange(max(1, -(-n_pairs // FILE_PAIRS)), "a", "b")
    done = store(spread.mapInArrow(write, "name string"), f"{folder}/names")
    return sorted(r["name"] for r in done.collect())


def scored(links: DataFrame, names: list[str]) -> DataFrame:
    """Aligned documents, with n_best and count_sum in place of their links; other columns stay.

    A task holds one file of counts and SCORED links at a time, or one document's.
    """
    others = [c for c in links.columns if c != "links"]

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w.keep_only()
        for whole in rows:
            sizes = np.cumsum(whole.column("n_links").to_numpy())
            first = 0
            while first < whole.num_rows:
                done = int(sizes[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, done + SCORED, "right")))
                batch, first = whole.slice(first, last - first), last
                codes, n = _codes(batch)
                distinct, back = np.unique(codes, return_inverse=True)
                distinct = _wide(distinct)
                count, best = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
                for name in names:
                    keys = files.mapped(f"{name}.codes", "<u8")
                    lo, hi = np.searchsorted(distinct, keys[0]), np.searchsorted(distinct, keys[-1], "right")
                    if lo < hi:
                        at = np.minimum(np.searchsorted(keys, distinct[lo:hi]), len(keys) - 1)
                        hit = keys[at] == distinct[lo:hi]
                        count[lo:hi][hit] = files.mapped(f"{name}.counts", "<i8")[at[hit]]
                        best[lo:hi][hit] = files.mapped(f"{name}.best", "u1")[at[hit]].astype(bool)
                ends = np.concatenate(([0], np.cumsum(n)))
                out = []
                for values in (best[back].astype(np.int64), count[back]):
                    sums = np.concatenate(([0], np.cumsum(values)))
                    out.append(pa.array(sums[ends[1:]] - sums[ends[:-1]]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *out], names=[*others, "n_best", "count_sum"])

    kinds = T.StructType([*links.select(*others).schema, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return links.mapInArrow(score, kinds)


def align(docs: DataFrame, path_a: str, path_b: str, folder: str | None = None) -> DataFrame:
    """Per row of the documents: doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    `path_a` and `path_b` are paths that every executor has. groups is
    'a1,a2|b1;a3|b2,b3': ids of A and of B in each group. A link is a pair of tokens
    whose byte ranges overlap; n_best counts the links whose id pair is linked as often
    in all documents as any with its B id, count_sum adds up how often each link's
    pair is. Special tokens' strings are ordinary text. A null or empty text has no
    tokens, nor has one that either tokenizer does not keep byte by byte: zeros, groups
    '', and nothing counted. Rows of one doc_id are rows of their own. An empty table
    gives none. Other columns are not read.
    """
    folder = folder or shared_folder(docs.sparkSession, "align")
    links = aligned(docs, path_a, path_b, f"{folder}/aligned")
    return scored(links, counted(links, folder))


def counted(links: DataFrame, folder: str) -> list[str]:
    """Count the id pairs of aligned documents; the names of the files that hold the counts."""
    pairs = store(pair_counts(links), f"{folder}/pairs")
    return write_counts(pairs, f"{folder}/counts", pairs.count())
