"""Substring dedup over words by level-wise doubling.

A window can repeat at length 2n only if both its halves repeat. So fingerprints
of all windows of 9 words are exchanged first; only where a window and the one
that follows it were both found elsewhere is the window of 18 words sent, and so on
to the full length, where the second half overlaps the first by as much as the length
is short of the double. Levels before the last are filters and send 40 bits; the
last sends 96. Each level is a pass over the packed runs, without moving texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsetide.llm import files, runs as r, words as w
from pulsetide.session import shared_folder

LENGTH = 35
FIRST = 9
FILTER_BITS = 40
CHECK = np.uint64(0xA24BAED4963EE407)


def levels_of(length: int, first: int = FIRST) -> list[int]:
    """Lengths from the full one down by halves, shortest first."""
    found = [length]
    while found[0] > first:
        found.insert(0, max(-(-found[0] // 2), 1))
    return found


def _words(texts: w.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words, and where each document's words start."""
    hashes, first, base = [], [np.zeros(1, np.int64)], 0
    for _, _, part in w.slices(texts):
        words = w.words_of(part)
        hashes.append(w.word_hashes(words))
        first.append(words.first[1:] + base)
        base += len(words.start)
    return np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.concatenate(first)


def _values(hashes: np.ndarray, at: np.ndarray, length: int, last: bool) -> tuple[np.ndarray, np.ndarray | None]:
    full = w.window_hashes(hashes, at, length)
    if not last:
        return full >> np.uint64(64 - FILTER_BITS), None
    # The check bits come from other fingerprints of the same words.
    return full, w.window_hashes(w.mix(hashes ^ CHECK), at, length) >> np.uint64(32)


def _distinct(values: np.ndarray, checks: np.ndarray | None):
    """Sorted distinct fingerprints, their checks, which occur more than once, and of each window its place among them."""
    if checks is None:
        distinct, back, n = np.unique(values, return_inverse=True, return_counts=True)
        return distinct, None, n > 1, back
    order = np.lexsort((checks, values))
    v, c = values[order], checks[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (c[1:] != c[:-1])
    group = np.cumsum(new) - 1
    back = np.empty(len(v), np.int64)
    back[order] = group
    return v[new], c[new], np.bincount(group, minlength=int(new.sum())) > 1, back


def _candidates(hashes, first, run: int, level: int, levels: list[int], folder: str) -> np.ndarray:
    """Word positions whose window of this level's length may repeat: all, or what the level before leaves."""
    if level == 0:
        return w.window_starts(first, levels[0])
    shorter, longer = levels[level - 1], levels[level]
    found = np.zeros(len(hashes) + longer, bool)
    found[_repeated(hashes, first, run, level - 1, levels, folder)] = True
    at = w.window_starts(first, longer)
    return at[found[at] & found[at + longer - shorter]]


def _repeated(hashes, first, run: int, level: int, levels: list[int], folder: str) -> np.ndarray:
    """Positions whose window of this level's length was found elsewhere, from the answers."""
    at = _sent(first, run, level, levels, folder)
    last = level == len(levels) - 1
    distinct, _, _, back = _distinct(*_values(hashes, at, levels[level], last))
    return at[r.answered(f"{folder}/answers{level}", run, len(distinct))[back]]


def _sent(first, run: int, level: int, levels: list[int], folder: str) -> np.ndarray:
    if level == 0:
        return w.window_starts(first, levels[0])
    kept = r.load(f"{folder}/sent{level}/{run}")
    return np.flatnonzero(np.unpackbits(kept["bits"], count=int(kept["n"][0])))


def repeated_words(docs: DataFrame, length: int = LENGTH, folder: str | None = None) -> DataFrame:
    """Per row of the documents: doc_id, n_words, n_removed, kept_sha256, and kept, the text of the words that stay.

    A word goes if any window of `length` words that covers it also starts
    anywhere else, in the same document or another, as the texts came in. Null
    and empty texts and texts shorter than a window lose nothing; rows that repeat
    a text repeat its windows. Kept words are joined by one space. An empty table
    gives none; other columns are not read.
    """
    folder = folder or shared_folder(docs.sparkSession, "substrings")
    levels = levels_of(length)
    packed = r.pack(docs, folder)
    parts = 0
    for level in range(len(levels)):
        if level:
            files.make_folder(f"{folder}/sent{level}")
        if not parts:
            # Windows are fewer than words, and words fewer than half of the packed bytes.
            total = packed.agg(F.sum(F.length("blob"))).first()[0] or 0
            parts = max(1, -(-int(total) // (2 * r.PART_VALUES)))
        last = level == len(levels) - 1
        sent = packed.mapInArrow(_sender(level, levels, folder, parts, last), r.SENT)
        count = r.exchange(sent, f"{folder}/answers{level}")
        if not count:
            levels = levels[: level + 1]
            break
    none = not count
    return packed.mapInArrow(
        _remover(levels, folder, none, length), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )


def _sender(level: int, levels: list[int], folder: str, parts: int, last: bool):
    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, _, texts in r.opened(rows):
            hashes, first = _words(texts)
            at = _candidates(hashes, first, run, level, levels, folder)
            if level:
                mask = np.zeros(len(hashes), bool)
                mask[at] = True
                r.save(f"{folder}/sent{level}/{run}", bits=np.packbits(mask), n=np.array([len(mask)]))
            distinct, checks, many, _ = _distinct(*_values(hashes, at, levels[level], last))
            yield r.send_values(run, distinct, checks, many, 64 if last else FILTER_BITS, parts)

    return send


def _remover(levels: list[int], folder: str, none: bool, length: int):
    def remove(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, ids, texts in r.opened(rows):
            hashes, first = _words(texts)
            at = np.zeros(0, np.int64) if none else _repeated(hashes, first, run, len(levels) - 1, levels, folder)
            gone = w.covered(len(hashes), at, length)
            base = 0
            for lo, hi, part in w.slices(texts):
                words = w.words_of(part)
                here = gone[base : base + len(words.start)]
                base += len(words.start)
                data = part.data.tobytes()
                kept = []
                for i in range(len(part)):
                    a, b = words.first[i], words.first[i + 1]
                    stay = np.flatnonzero(~here[a:b]) + a
                    kept.append(b" ".join([data[s:e] for s, e in zip(words.start[stay].tolist(), words.end[stay].tolist())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        pa.array(words.counts, pa.int64()),
                        pa.array(w.per_document(here, words.first), pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                )

    return remove
