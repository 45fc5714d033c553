"""Balanced parentheses in bits: rank, and findclose by range minima of the excess.

One bit a parenthesis (1 opens), packed into 64-bit words. For each word there is
a count of the set bits before it (rank) and the least excess inside it; above
those, a binary tree of minima. Finding the close of an open reads its word, climbs
the tree to the first later word whose minimum is low enough, and reads that word.
All functions take arrays of places.
"""

from __future__ import annotations

import numpy as np

_WORD = 64


class Bits:
    """A bit vector with ``rank``."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros(-(-self.n // _WORD) * _WORD + _WORD, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many bits before each place are set."""
        word, low = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << low) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)


class Parens(Bits):
    """A balanced sequence with ``close_of``."""

    def __init__(self, bits: np.ndarray):
        super().__init__(bits)
        steps = np.full(len(self.words) * _WORD, 1, np.int64)  # the padding only rises
        steps[: self.n] = 2 * bits.astype(np.int64) - 1
        least = np.cumsum(steps).reshape(-1, _WORD).min(axis=1)
        self.least = [least]
        while len(self.least[-1]) > 1:
            below = self.least[-1]
            if len(below) % 2:
                below = self.least[-1] = np.append(below, np.iinfo(np.int64).max)
            self.least.append(np.minimum(below[::2], below[1::2]))

    def excess(self, at: np.ndarray) -> np.ndarray:
        """Opens minus closes before each place."""
        return 2 * self.rank(at) - at

    def _scan(self, at: np.ndarray, excess: np.ndarray, target: np.ndarray, found: np.ndarray) -> None:
        """Reads on from ``at`` to the end of its word; ``found`` gets the place after which the target is reached."""
        left = np.arange(len(at))
        at, excess = at.copy(), excess.copy()
        while len(left):
            excess += 2 * self.get(at) - 1
            hit = excess == target[left]
            found[left[hit]] = at[hit]
            at += 1
            on = ~hit & (at & 63 != 0)
            left, at, excess = left[on], at[on], excess[on]

    def close_of(self, opens: np.ndarray) -> np.ndarray:
        """The place of the close that belongs to the open at each place."""
        target = self.excess(opens)
        found = np.full(len(opens), -1, np.int64)
        inside = np.flatnonzero(opens & 63 != 63)
        some = np.full(len(inside), -1, np.int64)
        self._scan(opens[inside] + 1, target[inside] + 1, target[inside], some)
        found[inside] = some
        rest = np.flatnonzero(found < 0)
        if len(rest):
            word = self._first_low(opens[rest] >> 6, target[rest])
            some = np.full(len(rest), -1, np.int64)
            start = word << 6
            self._scan(start, self.excess(start), target[rest], some)
            found[rest] = some
        return found

    def _first_low(self, word: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first word after each given one whose least excess is at most the target."""
        node, level = word.copy(), np.full(len(word), -1)
        for k, least in enumerate(self.least):
            climbing = level < 0
            right = np.minimum(node + 1, len(least) - 1)
            low = climbing & (node % 2 == 0) & (right > node) & (least[right] <= target)
            node[low] += 1
            level[low] = k
            node[climbing & ~low] >>= 1
        for k in range(len(self.least) - 2, -1, -1):
            going = level > k
            least = self.least[k]
            left = np.where(going, 2 * node, 0)
            node = np.where(going, np.where(least[left] <= target, left, left + 1), node)
        return node
