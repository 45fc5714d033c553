"""Quality rules: simple counts and repetition by suffix arrays (operator 5).

The repetition rule sorts the word suffixes of each text. In that order the
longest common prefix (LCP) of neighbours gives the LCP intervals, that is, all
maximal repeated substrings. A word is covered if an occurrence of a repeated
substring of at least ``MIN_REPEAT`` words covers it: the occurrence at a suffix
reaches as far as the larger LCP with its two neighbours. A text is rejected if
the covered share of its words or its longest repeat passes a limit.

Suffix arrays of many texts are built together by prefix doubling: classes of
equal prefixes of 1, 2, 4, ... words are refined until every suffix is alone, and
a first class holds words of one text only, so nothing matches across texts.

Defined results: null and empty texts have no words and fail the base rules;
repeated rows are judged each for itself; other columns are ignored; texts of any
length are read whole, and a batch holds one text at least.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally.llm.shared import documents, returning, whole_text
from gatetally.llm.wordmemo import chunks, sums_by_text

#: Shortest repeated substring that counts, in words.
MIN_REPEAT = 8
#: A text is rejected above this share of covered words, in percent.
MAX_COVERED = 40
#: A text is rejected if some substring of more words than this repeats.
MAX_REPEAT = 200
#: Fixed values of the base rules.
MIN_WORDS, MAX_REPEAT_WORDS, WINDOW = 50, 50, 3
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"

RESULT = """n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
    n_covered long, longest_repeat long"""
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]


def _classes(keys: np.ndarray) -> np.ndarray:
    """For each key the number of smaller keys: equal keys share a class."""
    order = np.argsort(keys, kind="stable")
    some = keys[order]
    first = np.concatenate([[True], some[1:] != some[:-1]]) if len(some) else np.zeros(0, bool)
    out = np.empty(len(keys), np.int64)
    out[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    return out


def _sizes(classes: np.ndarray) -> np.ndarray:
    return np.bincount(classes, minlength=len(classes))[classes] if len(classes) else classes


class SuffixOrder:
    """Order of all word suffixes of many texts; suffixes of different texts share no prefix.

    ``levels[t]`` holds the class of every suffix by its first 2^t words.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray, last: np.ndarray):
        """``words`` are word numbers, ``text`` text numbers, ``last`` the end of each word's text."""
        n = len(words)
        self.n = n
        width = int(words.max()) + 1 if n else 1
        self.levels = [_classes(text * width + words)]
        self.last = last
        step, active = 1, np.arange(n)
        while len(active):
            now = self.levels[-1]
            sizes = _sizes(now)
            active = active[sizes[active] > 1]
            if not len(active):
                break
            ahead = active + step
            inside = ahead < last[active]
            second = np.where(inside, now[np.minimum(ahead, n - 1)] + 1, 0)
            refined = now.copy()
            keys = now[active] * (n + 1) + second
            fine, coarse = _classes(keys), _classes(now[active])
            refined[active] = now[active] + fine - coarse
            self.levels.append(refined)
            step *= 2

    def order(self) -> np.ndarray:
        """The suffixes in order; the last level has every suffix alone."""
        out = np.empty(self.n, np.int64)
        out[self.levels[-1]] = np.arange(self.n)
        return out

    def lcp(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes ``a`` and ``b``, pair by pair of one text, have in common."""
        out = np.zeros(len(a), np.int64)
        for t in range(len(self.levels) - 1, -1, -1):
            level = self.levels[t]
            x, y = a + out, b + out
            end = self.last[a]
            fits = np.maximum(x, y) + (1 << t) <= end
            same = fits & (level[np.minimum(x, self.n - 1)] == level[np.minimum(y, self.n - 1)])
            out += same.astype(np.int64) << t
        return out


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places some run covers."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def repetition(words: list[list[bytes]], min_repeat: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: words in repeated 3-word windows, covered words, longest repeat."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    flat = np.fromiter((index[w] for ws in words for w in ws), np.int64, int(counts.sum()))
    n, text = len(flat), np.repeat(np.arange(len(words)), counts)
    last = np.repeat(np.cumsum(counts), counts)
    if not n:
        none = np.zeros(len(words), np.int64)
        return none, none.copy(), none.copy()
    suffixes = SuffixOrder(flat, text, last)
    order = suffixes.order()
    first = suffixes.levels[0]
    a, b = order[:-1], order[1:]
    near = first[a] == first[b]
    for level in suffixes.levels[1:2]:  # pairs with two words in common: shorter repeats count nowhere
        near &= level[a] == level[b]
    a, b = a[near], b[near]
    common = suffixes.lcp(a, b)
    reach = np.zeros(n, np.int64)
    np.maximum.at(reach, a, common)
    np.maximum.at(reach, b, common)
    windows = np.flatnonzero(reach >= WINDOW)
    repeated = _covered(windows, np.full(len(windows), WINDOW), n)
    longer = np.flatnonzero(reach >= min_repeat)
    covered = _covered(longer, reach[longer], n)
    longest = np.zeros(len(words), np.int64)
    np.maximum.at(longest, text[longer], reach[longer])
    return sums_by_text(repeated, counts), sums_by_text(covered, counts), longest


def measure(texts: list[str], min_repeat: int = MIN_REPEAT) -> list[np.ndarray]:
    """The columns of ``RESULT`` for each text."""
    words = [t.encode().split() for t in texts]
    chars = [len(t) - sum(map(t.count, SPACES)) for t in texts]
    symbols = [sum(map(t.count, SYMBOLS)) for t in texts]
    copies = []
    for t in texts:
        lines = [x for x in t.split("\n") if x.strip(SPACES)]
        copies.append(len(lines) - len(set(lines)))
    plain = [np.array(x, np.int64) for x in ([len(w) for w in words], chars, symbols, copies)]
    return [*plain, *repetition(words, min_repeat)]


def measure_batches(min_repeat: int, keep: list[str]):
    """A function for ``mapInArrow``: measures in place of texts, ``keep`` carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = [measure(texts[a:b], min_repeat) for a, b in chunks(texts)]
            found = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in zip(*parts, strict=True)] or [
                pa.array([], pa.int64()) for _ in _NAMES
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *found], names=[*keep, *_NAMES])

    return run


def rules(n_words, n_repeat_words, n_covered, longest_repeat, max_covered: int = MAX_COVERED, max_repeat: int = MAX_REPEAT):
    """Whether the base rules fail and whether the repetition rule holds, for columns or arrays alike."""
    failed = (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_WORDS * n_words)
    return failed, (100 * n_covered <= max_covered * n_words) & (longest_repeat <= max_repeat)


_JUDGED = ("n_words", "n_repeat_words", "n_covered", "longest_repeat")


def judged(rows: DataFrame) -> DataFrame:
    """Measured ``rows`` with ``base_failed`` and ``kept``."""
    failed, fine = rules(*(F.col(c) for c in _JUDGED))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for a, b in chunks(texts):
            found = dict(zip(_NAMES, measure(texts[a:b]), strict=True))
            failed, fine = rules(*(found[c] for c in _JUDGED))
            yield batch.slice(a, b - a).filter(pa.array(~failed & fine))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, in one narrow step."""
    return docs.mapInArrow(returning(_kept_batches), docs.schema)


def quality_rules(docs: DataFrame, key: str = "doc_id", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """Measures and verdict for each row of ``docs`` (``key``, text)."""
    rows = docs.select(F.col(key), whole_text().alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    return judged(rows.mapInArrow(measure_batches(min_repeat, [key]), f"`{key}` {kind}, {RESULT}"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict for every document."""
    return quality_rules(documents(spark, sf_dir))
