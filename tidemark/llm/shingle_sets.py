"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd numbers by which the words of a shingle are told apart by place, and mixed.
_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
     0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64,
)
_SHIFT = np.uint64(32)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that scatters them, another one for each seed."""
    out = values ^ _PLACES[seed]
    for factor in (_PLACES[6], _PLACES[7]):
        out = (out ^ (out >> _SHIFT)) * factor
    return out ^ (out >> _SHIFT)


class Shingler:
    """Shingles of `width` words; each distinct word is hashed once, up to a bound."""

    most_kept = 100_000

    def __init__(self, width: int):
        if not 1 <= width <= len(_PLACES):
            raise ValueError(f"a shingle has 1 to {len(_PLACES)} words")
        self.width = width
        self.known: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = xxhash.xxh3_64_intdigest(word)
            if len(self.known) >= self.most_kept:
                self.known.clear()
            self.known[word] = found
        return found

    def shingles(self, text: bytes) -> np.ndarray:
        """Distinct shingles in ascending order; of a text with fewer words, its whole
        sequence; of a text without words, none. A-Z count as a-z."""
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self._hash, words), np.uint64, len(words))
        width = min(self.width, len(words))
        count = len(words) - width + 1
        sums = np.full(count, width, np.uint64)
        for place in range(width):
            sums += mixed(hashes[place : place + count], place) * _PLACES[place]
        return np.unique(mixed(sums))


def set_number(shingles: np.ndarray) -> int:
    """A signed 64-bit number for a set; equal sets have equal numbers."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
