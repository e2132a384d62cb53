"""Texts as segments that tokenizers encode independently of each other.

A segment starts at a document's start and at every space that follows a
character which is no white space. Byte-level vocabularies split text there
before they merge, and a vocabulary of pieces does not merge across it where none
of its pieces holds a space behind another character (checked by who uses it). So
each distinct segment is worked on once per worker, and a joined string of
segments is encoded like each of them alone.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from pulsetide.llm import words as w

#: ASCII bytes that are surely no white space to any tokenizer, and bytes of longer characters.
_SOLID = np.zeros(256, bool)
_SOLID[33:127] = _SOLID[128:] = True
#: First bytes of the longer characters that are white space or stand for it, two and three bytes long.
_TWO, _THREE = 0xC2, (0xE1, 0xE2, 0xE3)


def solid_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is surely no white space."""
    ok = _SOLID[data[at - 1]] & (at > 0)
    long = data[at - 1] >= 128
    ok &= ~long | (data[np.maximum(at - 2, 0)] != _TWO)
    return ok & (~long | ~np.isin(data[np.maximum(at - 3, 0)], _THREE))


#: ASCII letters 1, digits 2, punctuation 3.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 3
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = 1


def _finer(data: np.ndarray) -> np.ndarray:
    """Places where byte-level vocabularies part text too: between ASCII letters, digits and punctuation, and around a lone line break.

    An apostrophe stays with the letters behind it, with which it may be one word.
    """
    kind = _CLASS[data]
    solid = kind > 0
    at = np.flatnonzero((kind[1:] != kind[:-1]) & solid[1:] & solid[:-1]) + 1
    at = at[(data[at - 1] != 39) | (kind[at] != 1)]
    line = np.flatnonzero(data[1:-1] == 10) + 1
    line = line[solid[line - 1] & (kind[line + 1] == 1)]
    return np.concatenate((at, line, line + 1))


def segments_of(texts: w.Texts, fine: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each segment, and of document i the segments first[i]:first[i + 1].

    Fine segments suit byte-level vocabularies alone.
    """
    data = texts.data
    space = np.flatnonzero(data == 32)
    cut = space[solid_before(data, space)] if len(space) else space
    # A lone space at a document's end stays with what is before it: alone, a model that sets a space itself would drop it.
    begins = np.zeros(len(data) + 1, bool)
    begins[cut] = True
    begins[texts.offsets[1:] - 1] = False
    if fine and len(data) > 1:
        begins[_finer(data)] = True
    begins[texts.offsets] = True
    start = np.flatnonzero(begins[:-1])
    stop = np.append(start[1:], len(data)) if len(start) else start
    return start, stop, np.searchsorted(start, texts.offsets)


#: Texts that are one string for a tokenizer.
TOGETHER = 64
#: Strings that a tokenizer gets in one call.
AT_ONCE = 1_024
#: Slots of an empty table of fingerprints.
LEAST = 1 << 16


class Known:
    """Places of the segments met so far, by a fingerprint of 64 bits.

    `learn(segments, solid)` takes the new ones in the order of their places; solid tells
    which of them end in no white space, so that another may follow in one string. What
    was learned is forgotten when `most` would be passed, which only costs time.

    A table of open addresses, at most half full, has the places by fingerprint, so a look-up neither sorts nor searches.
    """

    def __init__(self, most: int, forget: Callable[[], None], learn: Callable[[list[bytes], np.ndarray], None]):
        self.most, self._forget, self._learn = most, forget, learn
        self._clear()

    def _clear(self) -> None:
        self.n = 0
        self.keys = np.zeros(LEAST // 2, np.uint64)
        self._table(LEAST)
        self._forget()

    def _table(self, size: int) -> None:
        self.place = np.full(size, -1, np.int32)
        self.shift = np.uint64(65 - size.bit_length())

    def _slots(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each fingerprint is, or the free slot at which its search ended, and its place, -1 if it has none."""
        last = len(self.place) - 1
        slot = (hashes >> self.shift).astype(np.int64)
        place = self.place[slot]
        left = np.flatnonzero((place >= 0) & (self.keys[place] != hashes))
        while len(left):
            at = (slot[left] + 1) & last
            slot[left], place[left] = at, (have := self.place[at])
            left = left[(have >= 0) & (self.keys[have] != hashes[left])]
        return slot, place

    def _put(self, first: int) -> None:
        """Enter the places from the first on, whose keys are distinct and not in the table."""
        places = np.arange(first, self.n, dtype=np.int32)
        while len(places):
            slot, _ = self._slots(self.keys[places])
            # Of those that ended at the same free slot one stays, the others search on.
            self.place[slot] = places
            places = places[self.place[slot] != places]

    def _add(self, hashes: np.ndarray) -> None:
        first, self.n = self.n, self.n + len(hashes)
        self.keys = room(self.keys, self.n)
        self.keys[first : self.n] = hashes
        if 2 * self.n > len(self.place):
            self._table(1 << (2 * self.n - 1).bit_length())
            first = 0
        self._put(first)

    def places(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        hashes = w.span_hashes(data, start, stop)
        places = self._slots(hashes)[1]
        missed = np.flatnonzero(places < 0)
        if not len(missed):
            return places
        new, one = np.unique(hashes[missed], return_index=True)
        if self.n + len(new) > self.most:
            self._clear()
            missed = np.arange(len(hashes))
            new, one = np.unique(hashes, return_index=True)
        raw, at_start, at_stop = data.tobytes(), start[missed[one]], stop[missed[one]]
        self._learn([raw[s:e] for s, e in zip(at_start.tolist(), at_stop.tolist())], solid_before(data, at_stop))
        self._add(new)
        places[missed] = self._slots(hashes[missed])[1]
        return places


class Held:
    """Ids of what was learned, place after place."""

    def __init__(self):
        self.n = self.n_ids = 0
        self.at, self.ids = np.zeros(1 << 12, np.int32), np.zeros(1 << 14, np.uint32)

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        self.at = room(self.at, self.n + len(size) + 1)
        self.ids = room(self.ids, self.n_ids + len(ids))
        self.at[self.n + 1 : self.n + 1 + len(size)] = self.n_ids + np.cumsum(size)
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n, self.n_ids = self.n + len(size), self.n_ids + len(ids)

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some places end to end, and where each one's start, and the end."""
        at = self.at[places]
        size = self.at[places + 1] - at
        sums = np.zeros(len(places) + 1, np.int64)
        np.cumsum(size, out=sums[1:])
        where = np.repeat(at - sums[:-1], size)
        where += np.arange(len(where))
        return self.ids[where], sums


def room(values: np.ndarray, n: int) -> np.ndarray:
    """The values with room for n, a quarter more than they need."""
    if n <= len(values):
        return values
    out = np.zeros((n + n // 4, *values.shape[1:]), values.dtype)
    out[: len(values)] = values
    return out


def encoded_together(
    ids_of: Callable[[list[str]], list[list[int]]], texts: list[bytes], fit: np.ndarray, between: bytes, border: np.ndarray, last: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts end to end, and how many each has.

    Those that fit are encoded TOGETHER in one string, as a call's overhead is more than its
    work. `border` tells of an id that it is a text's last (or else first) one and no
    other. A string with more or fewer such ids than texts is encoded text by text.
    """
    size = np.zeros(len(texts), np.int64)
    fit = np.flatnonzero(fit)
    groups = np.arange(0, len(fit), TOGETHER)
    counts = np.diff(groups, append=len(fit))
    chosen = [texts[i] for i in fit.tolist()]
    flat, n = _ids_of(ids_of, [between.join(chosen[i : i + TOGETHER]) for i in groups.tolist()])
    marked = np.append(border[flat], False)
    mark = np.flatnonzero(marked)
    stop = np.cumsum(n)
    good = np.diff(np.searchsorted(mark, stop), prepend=0) == counts
    good &= marked[stop - 1 if last else stop - n]
    # Of the groups that are good alone, each text's ids end where the next one's begin.
    kept = flat[np.repeat(good, n)]
    mark = np.flatnonzero(border[kept])
    together = fit[np.repeat(good, counts)]
    size[together] = np.diff(mark, prepend=-1) if last else np.diff(mark, append=len(kept))
    alone = np.ones(len(texts), bool)
    alone[together] = False
    single, size[alone] = _ids_of(ids_of, [texts[i] for i in np.flatnonzero(alone).tolist()])
    out = np.zeros(int(size.sum()), np.uint32)
    own = np.repeat(alone, size)
    out[own], out[~own] = single, kept
    return out, size


def _ids_of(ids_of: Callable[[list[str]], list[list[int]]], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts end to end and how many each has; what a tokenizer returns is held for some texts only."""
    flat, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for i in range(0, len(texts), AT_ONCE):
        got = ids_of([t.decode("utf-8", "replace") for t in texts[i : i + AT_ONCE]])
        size.append(np.fromiter(map(len, got), np.int64, len(got)))
        flat.append(np.fromiter(chain.from_iterable(got), np.uint32, int(size[-1].sum())))
    return np.concatenate(flat), np.concatenate(size)
