"""Words and windows of an Arrow text column as numpy arrays.

Every word pattern of this package is ruled by ASCII bytes alone, so words are
found on the UTF-8 bytes: no byte of a longer character is an ASCII byte. A
batch is worked on as one byte array with document borders, in slices of whole
documents, so memory follows the slice and the longest document.

Word and window fingerprints are polynomials modulo 2**64 over random odd-based
powers, then mixed. Two different words or windows agree by chance only
(2**-57 or less per pair); callers that must not depend on that compare bytes.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Odd, and 3 modulo 4: differences of its powers keep almost all bits.
BASE = np.uint64(0x9E3779B97F4A7C17 | 3)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = np.uint64(0xD1342543DE82EF97 | 3)
STEP_INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))
BYTE_VALUE = np.random.default_rng(20_240_101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text without A-Z
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_worker_caches: list[dict] = []


def worker_cache() -> dict:
    """A dict that lives as long as the worker, until a task of another operator has no use for it (`keep_only`)."""
    _worker_caches.append({})
    return _worker_caches[-1]


def keep_only(*mine: dict) -> None:
    """Drop what other operators left in this worker: Spark uses a worker again for the next stage.

    A function made for a task is sent with copies of the dicts it names, so one that names its
    cache here drops that too: functions of modules, which are not sent but imported, call this.
    """
    left = [cache for cache in _worker_caches if cache and not any(cache is own for own in mine)]
    for cache in left:
        cache.clear()
    if left:
        # What lay in them refers to itself, and Python doesn't see how large a tokenizer is.
        gc.collect()
    for base in [b for b, have in _powers.items() if len(have) > SLICE_BYTES]:
        del _powers[base]
    pa.default_memory_pool().release_unused()
    give_back()


def give_back() -> None:
    """What numpy and tokenizers freed stays with the process until the allocator is told to return it."""
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 2 * SLICE_BYTES:
            _powers[int(base)] = have
    return have[:n]


@dataclass
class Texts:
    """Texts of some documents end to end: document i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def column(values: pa.Array | pa.ChunkedArray) -> pa.LargeBinaryArray:
    """A string column as bytes, null as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(pa.large_string()).fill_null("").cast(pa.large_binary())


def texts_of(values: pa.Array | pa.ChunkedArray) -> Texts:
    arr = column(values)
    _, offsets, data = arr.buffers()
    ends = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(whole[ends[0] : ends[-1]], ends - ends[0])


def slices(texts: Texts, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first, last + 1, texts) of slices of whole documents, of about `most` bytes."""
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(texts.offsets, texts.offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        lo, hi = texts.offsets[first], texts.offsets[last]
        yield first, last, Texts(texts.data[lo:hi], texts.offsets[first : last + 1] - lo)
        first = last


@dataclass
class Words:
    """Words of some documents: start and end in the data, and of document i the words first[i]:first[i + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(texts: Texts, kind: np.ndarray = SPACED, lower: bool = False) -> Words:
    data = LOWER[texts.data] if lower else texts.data
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(texts) + 1, np.int64))
    inside = kind[data]
    border = np.zeros(n + 1, bool)
    border[texts.offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | border[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | border[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, texts.offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of byte spans."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    values = BYTE_VALUE[data]
    values *= powers(BASE, n + 1)[:n]
    np.cumsum(values, out=sums[1:])
    h = sums[end] - sums[start]
    h *= powers(BASE_INVERSE, n + 1)[start]
    h += (end - start).astype(np.uint64)
    return mix(h)


def word_hashes(words: Words) -> np.ndarray:
    return span_hashes(words.data, words.start, words.end)


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Word positions at which a window of `length` words of one document starts."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    total = int(counts.sum())
    shift = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total) + shift


def window_hashes(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the windows of `length` words that start at the given word positions."""
    if not len(at):
        return np.zeros(0, np.uint64)
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(STEP, n + 1)[:n], out=sums[1:])
    h = sums[at + length] - sums[at]
    h *= powers(STEP_INVERSE, n + 1)[at]
    return mix(h + np.uint64(length))


def covered(n: int, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of n positions lie in a window at[i] : at[i] + length."""
    change = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
    return np.cumsum(change[:-1]) > 0


def per_document(mask: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Count of true positions per document."""
    sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return sums[first[1:]] - sums[first[:-1]]


def batches(rows: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Arrow batches cut into slices of whole documents, with their texts."""
    for batch in rows:
        if batch.num_rows:
            for first, last, part in slices(texts_of(batch.column(text)), most):
                yield batch.slice(first, last - first), part
