"""64-bit hashes of many substrings at once.

With random numbers ``t[c]`` for bytes and an odd base ``B``, the prefix sums
``p[i] = sum(t[c_j] * B^j, j < i)`` modulo 2^64 give the hash of any substring as
``(p[end] - p[start]) * B^-start``, the same wherever the substring stands.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240531).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


#: Powers are kept for arrays of up to 2^KEPT_BITS bytes and made anew for longer ones.
KEPT_BITS = 21


def _made(bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_BASE, _INVERSE):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


@lru_cache(maxsize=1)
def _kept() -> tuple[np.ndarray, np.ndarray]:
    return _made(KEPT_BITS)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    return _kept() if size <= 1 << KEPT_BITS else _made(size.bit_length())


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """Substring hashes of one byte array."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * power[: len(data)], out=self.prefix[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each ``data[start:end]``."""
        return mixed((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def rolling(self, size: int) -> np.ndarray:
        """The hash of every substring of ``size`` bytes, by start."""
        n = max(0, len(self.prefix) - size)
        return mixed((self.prefix[size:] - self.prefix[:n]) * self.inverse[:n])


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts with a line break behind each, and where each text starts (and the end)."""
    raw = [t.encode() for t in texts]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    return np.frombuffer(b"\n".join([*raw, b""]), np.uint8), starts


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def class_table(members: bytes) -> np.ndarray:
    """Which byte values are among ``members``."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of words: all but the ASCII white space.
NOT_SPACE = ~class_table(b" \t\n\x0b\f\r")
#: Bytes of plain words: ASCII letters and digits, the apostrophe and everything beyond ASCII.
PLAIN = class_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'" + bytes(range(128, 256)))
