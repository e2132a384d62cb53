"""Characters of UTF-8 bytes by a sparse exception index.

Most text is ASCII, where a character's place is its byte's. Only the others are
recorded: where each multibyte character starts and how many bytes it has beyond
one. A search among these few turns code points into bytes and back; between them
the step is plain arithmetic. Memory follows the multibyte characters.
"""

from __future__ import annotations

import numpy as np


class Exceptions:
    """The multibyte characters of some UTF-8 bytes: place in bytes, in code points, and excess bytes before each."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate(([0], np.cumsum(excess)))
        self.char = self.byte - self.before[:-1]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before each byte position; positions lie at borders of characters."""
        return byte - self.before[np.searchsorted(self.byte, byte, "left")]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Bytes before each code point position."""
        return char + self.before[np.searchsorted(self.char, char, "left")]
