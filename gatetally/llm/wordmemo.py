"""Token ids of the distinct words of a stream of texts, kept within a bound."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import repeat

import numpy as np


class WordMemo:
    """Maps words to runs of token ids; holding ``limit`` words, it forgets the half not used for longest.

    ``encode`` gets a list of distinct words and returns the ids of each as the
    bytes of 32-bit numbers. Runs lie in one flat array, so that the ids of many
    words are gathered at once.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.used_at = np.zeros(1024, np.int64)
        self.clock = 0
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.int32)
        self.used = 0

    def _room(self, name: str, size: int) -> np.ndarray:
        array = getattr(self, name)
        if size > len(array):
            grown = np.zeros(max(size, 2 * len(array)), array.dtype)
            grown[: len(array)] = array
            setattr(self, name, grown)
            return grown
        return array

    def slots(self, words: list[str]) -> np.ndarray:
        """The slot of every word; new words are encoded first."""
        slots = self._found(words)
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            fresh = list({words[i] for i in unknown.tolist()})
            if len(self.index) + len(fresh) > self.limit and self.index:
                self._forget(words)
                slots = self._found(words)
                unknown = np.flatnonzero(slots < 0)
                fresh = list({words[i] for i in unknown.tolist()})
            runs = self.encode(fresh)
            lengths = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
            total, first = int(lengths.sum()), len(self.index)
            self._room("flat", self.used + total)[self.used : self.used + total] = np.frombuffer(
                b"".join(runs), np.int32
            )
            last = first + len(fresh)
            self._room("lengths", last)[first:last] = lengths
            self._room("used_at", last)
            self._room("starts", last)[first:last] = self.used + np.cumsum(lengths) - lengths
            self.used += total
            self.index.update(zip(fresh, range(first, last), strict=True))
            slots[unknown] = self._found([words[i] for i in unknown.tolist()])
        self.clock += 1
        self.used_at[slots] = self.clock
        return slots

    def _found(self, words: list[str]) -> np.ndarray:
        """The slot of every word, -1 where there is none."""
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def _forget(self, words: list[str]) -> None:
        """Keep the half that was used last, those of ``words`` among it; all go if that leaves no room."""
        self.clock += 1
        asked = [self.index[w] for w in set(words) if w in self.index]
        self.used_at[asked] = self.clock
        n, keep = len(self.index), self.limit // 2
        kept = np.sort(np.argsort(-self.used_at[:n], kind="stable")[:keep])
        names, flat, lengths, used_at = list(self.index), *self.ids(kept), self.used_at[kept]
        clock = self.clock
        self._clear()
        self.clock = clock
        self.index = {names[i]: slot for slot, i in enumerate(kept.tolist())}
        self._room("flat", len(flat))[: len(flat)] = flat
        self._room("lengths", len(kept))[: len(kept)] = lengths
        self._room("starts", len(kept))[: len(kept)] = np.cumsum(lengths) - lengths
        self._room("used_at", len(kept))[: len(kept)] = used_at
        self.used = len(flat)

    def ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in ``slots``, end to end, and each word's number of ids."""
        return _gathered(self.flat, self.starts[slots], self.lengths[slots])


class HashMemo:
    """Like ``WordMemo`` for words given by 64-bit hashes; the strings are asked for when a word is new only.

    Words with equal hashes count as equal. Slots are found in an open table, at
    the first place from the hash's low bits on that holds the hash or nothing.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int):
        self.encode, self.limit, self.clock = encode, limit, 0
        self._fill(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _fill(self, keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray, used_at: np.ndarray) -> None:
        self.keys, self.flat, self.lengths, self.used_at = keys, flat, lengths, used_at
        self.starts = np.cumsum(lengths) - lengths
        self.table = np.full(1 << max(16, (3 * len(keys)).bit_length()), -1, np.int32)
        self._enter(np.arange(len(keys)))

    def _enter(self, slots: np.ndarray) -> None:
        mask = np.uint64(len(self.table) - 1)
        at = self.keys[slots] & mask
        while len(slots):
            free = self.table[at] < 0
            self.table[at[free]] = slots[free]
            left = self.table[at] != slots
            slots, at = slots[left], (at[left] + np.uint64(1)) & mask

    def _found(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.table) - 1)
        slots = self.table[hashes & mask].astype(np.int64)
        if not len(self.keys):
            return slots
        left = np.flatnonzero((slots >= 0) & (self.keys[slots] != hashes))
        at = hashes[left] & mask
        while len(left):
            at = (at + np.uint64(1)) & mask
            slots[left] = self.table[at]
            other = (slots[left] >= 0) & (self.keys[slots[left]] != hashes[left])
            left, at = left[other], at[other]
        return slots

    def slots(self, hashes: np.ndarray, words: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """The slot of every word; ``words`` gives the strings of those at some places of ``hashes``."""
        self.clock += 1
        slots = self._found(hashes)
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            fresh, first = np.unique(hashes[unknown], return_index=True)
            if len(self.keys) + len(fresh) > self.limit and len(self.keys):
                self.used_at[slots[slots >= 0]] = self.clock
                self._forget()
                slots = self._found(hashes)
                unknown = np.flatnonzero(slots < 0)
                fresh, first = np.unique(hashes[unknown], return_index=True)
            runs = self.encode(words(unknown[first]))
            lengths = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
            self._add(fresh, np.frombuffer(b"".join(runs), np.int32), lengths)
            slots[unknown] = self._found(hashes[unknown])
        self.used_at[slots] = self.clock
        return slots

    def _add(self, fresh: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.keys)
        ends = len(self.flat) + np.cumsum(lengths)
        self.keys = np.concatenate([self.keys, fresh])
        self.starts = np.concatenate([self.starts, ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used_at = np.concatenate([self.used_at, np.full(len(fresh), self.clock)])
        self.flat = np.concatenate([self.flat, flat])
        if 2 * len(self.keys) > len(self.table):
            self._fill(self.keys, self.flat, self.lengths, self.used_at)
        else:
            self._enter(np.arange(n, len(self.keys)))

    def _forget(self) -> None:
        """Keep the half that was used last."""
        kept = np.sort(np.argsort(-self.used_at, kind="stable")[: self.limit // 2])
        flat, lengths = self.ids(kept)
        self._fill(self.keys[kept], flat, lengths, self.used_at[kept])

    def ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in ``slots``, end to end, and each word's number of ids."""
        return _gathered(self.flat, self.starts[slots], self.lengths[slots])


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)], lengths


def as_runs(flat: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The ids in ``flat`` as one run for each of the ``lengths``."""
    raw, ends = flat.astype(np.int32).tobytes(), 4 * np.cumsum(lengths)
    return [raw[a:b] for a, b in zip((ends - 4 * lengths).tolist(), ends.tolist(), strict=True)]


def chunks(texts: Sequence[str], most: int = 2_000_000) -> Iterable[tuple[int, int]]:
    """Runs of texts, as (first, last), of about ``most`` characters or one text each."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def sums_by_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``, where ``counts`` are the lengths of the runs."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - counts]
