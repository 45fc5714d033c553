"""SentencePiece encoding and decoding by suffix-array matching (operator 1).

The distinct segments of a batch (see ``segments``) are laid end to end. A suffix
array of that text, sorted to the length of the longest piece, is searched for
every piece of the vocabulary at once by bisection; the ranges found are all
occurrences of all pieces. Each occurrence is an edge from its first position to
the one behind it.

Edges sorted by their position in the segment are then relaxed from left to
right, all segments together. The vocabulary is one of byte-pair merges, so the
best path is not one of largest scores but the result of the merges. A sequence
of pieces is that result exactly if every two neighbours, merged by themselves,
stay these two pieces: no merge ever crosses a boundary of the result, and
merges on either side of a boundary do not depend on each other. Each prefix has
one encoding, so of the edges into a position exactly one fits the last piece at
its start. Whether two pieces fit is worked out when first asked and kept in a table of
fixed size, in which a later pair may take the place of an earlier one.

A character that is no piece becomes the pieces of its bytes. Decoding joins the
bytes of the pieces and drops the blank that encoding puts in front.

Defined results: null and empty texts have no ids; repeated rows are encoded each
for itself; other columns are ignored; texts of any length are read whole. The
sign U+2581 in a text decodes as a blank, as in the library; ``roundtrip`` is
false there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally.llm.bpe_counts import MODEL, merged, piece_ranks
from gatetally.llm.segments import SIGN, segment_keys, segment_of
from gatetally.llm.shared import documents, returning, whole_text
from gatetally.llm.wordmemo import WordMemo, as_runs, chunks, sums_by_text

#: Characters packed into one 60-bit key, and their width; the codes of a vocabulary must fit.
_PACK, _BITS = 5, 12
#: Characters indexed together, and characters of text that a step holds.
INDEX, CHUNK = 250_000, 1_000_000
#: Segments whose ids a worker remembers (about 200 bytes each).
REMEMBERED = 200_000
#: Places for pairs of pieces (8 bytes each).
PAIRS = 1 << 20


def _packed(codes: np.ndarray) -> np.ndarray:
    """For each position the next ``_PACK`` codes as one number."""
    padded = np.concatenate([codes, np.zeros(_PACK, np.int64)])
    out = np.zeros(len(codes), np.int64)
    for i in range(_PACK):
        out = (out << _BITS) | padded[i : i + len(codes)]
    return out


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys and the dense rank of each."""
    order = np.argsort(keys, kind="stable")
    some = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate([[0], some[1:] != some[:-1]]))
    return order, ranks


def _bisect(values: np.ndarray, low: np.ndarray, high: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each key the first place in its range ``[low, high)`` of sorted values that is not below it."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        below = open_ & (values[np.minimum(middle, len(values) - 1)] < keys)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)


class Vocabulary:
    """The pieces of a model file, as the matching and the relaxation need them."""

    def __init__(self, path: str):
        import sentencepiece as sp

        model = sp.SentencePieceProcessor(model_file=path)
        self.ranks = piece_ranks(path)
        self.pieces = list(self.ranks)
        self.ids = np.array([model.piece_to_id(p) for p in self.pieces], np.int32)
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.codes = {c: i + 1 for i, c in enumerate(sorted({c for p in self.pieces for c in p}))}
        if len(self.codes) >= 1 << _BITS:
            raise ValueError("the vocabulary has too many characters for packed keys")
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.blocks = -(-int(self.lengths.max()) // _PACK)
        table = np.zeros((len(self.pieces), self.blocks * _PACK), np.int64)
        for row, piece in zip(table, self.pieces, strict=True):
            row[: len(piece)] = [self.codes[c] for c in piece]
        shifts = 1 << (_BITS * np.arange(_PACK - 1, -1, -1, dtype=np.int64))
        self.keys = (table.reshape(-1, self.blocks, _PACK) * shifts).sum(2)
        self.alone = np.array([len(merged(p, self.ranks)[0]) == 1 for p in self.pieces])
        self._pairs = np.full(PAIRS, -1, np.int64)  # twice the pair's number, plus one if it fits
        self.lookup = np.zeros(0x110000, np.int16)
        for c, i in self.codes.items():
            self.lookup[ord(c)] = i

    def occurrences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and piece number of every occurrence of every piece."""
        packed = _packed(codes)
        order, ranks = _ranks(packed)
        depth = _PACK
        while depth < self.blocks * _PACK:
            behind = np.concatenate([ranks[depth:] + 1, np.zeros(min(depth, len(ranks)), np.int64)])
            order, ranks = _ranks(ranks * (len(ranks) + 1) + behind)
            depth *= 2
        n, count = len(codes), len(self.pieces)
        low, high = np.zeros(count, np.int64), np.full(count, n)
        for block in range(self.blocks):
            some = np.flatnonzero((self.lengths > block * _PACK) & (low < high))
            at = order + block * _PACK
            values = np.where(at < n, packed[np.minimum(at, n - 1)], 0)
            left = np.minimum(self.lengths[some] - block * _PACK, _PACK)
            first = self.keys[some, block]
            beyond = first + (np.int64(1) << (_BITS * (_PACK - left)))
            a, b = low[some], high[some]
            low[some] = _bisect(values, a, b, first)
            high[some] = _bisect(values, a, b, beyond)
        found = high - low
        ends = np.cumsum(found)
        inside = np.arange(int(ends[-1])) - np.repeat(ends - found, found)
        return order[np.repeat(low, found) + inside], np.repeat(np.arange(count), found)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pieces ``left`` and ``right``, merged by themselves, stay two."""
        key = left * len(self.pieces) + right
        place = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % PAIRS
        held = self._pairs[place]
        fit = held & 1 == 1
        missed = np.flatnonzero(held >> 1 != key)
        if len(missed):
            new, back = np.unique(key[missed], return_inverse=True)
            pairs = [(self.pieces[k // len(self.pieces)], self.pieces[k % len(self.pieces)]) for k in new.tolist()]
            good = np.array([merged(a + b, self.ranks)[0] == [a, b] for a, b in pairs], bool)
            fit[missed] = good[back]
            self._pairs[place[missed]] = 2 * key[missed] + good[back]
        return fit

    def encode(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment, as runs of 32-bit numbers."""
        text = "\0".join(segments) + "\0"
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        codes = self.lookup[points].astype(np.int64)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        word = np.repeat(np.arange(len(segments)), sizes + 1)
        offset = np.arange(len(codes)) - begin[word]
        inside = offset < sizes[word]
        start, piece = self.occurrences(codes)
        # Edges by position in the segment: those of one position come together.
        by = np.argsort(offset[start], kind="stable")
        start, piece = start[by], piece[by]
        bounds = np.searchsorted(offset[start], np.arange(int(sizes.max()) + 2))
        unknown = np.flatnonzero(inside & (codes == 0))
        unknown = unknown[np.argsort(offset[unknown], kind="stable")]
        gaps = np.searchsorted(offset[unknown], np.arange(int(sizes.max()) + 2))
        first, none = -1, -2
        last = np.full(len(codes) + 1, none)
        last[begin] = first
        for at in range(int(sizes.max())):
            s, p = start[bounds[at] : bounds[at + 1]], piece[bounds[at] : bounds[at + 1]]
            before = last[s]
            good = np.zeros(len(s), bool)
            fresh = before == first
            good[fresh] = self.alone[p[fresh]]
            good[~fresh] = self.fits(before[~fresh], p[~fresh])
            last[s[good] + self.lengths[p[good]]] = p[good]
            lone = unknown[gaps[at] : gaps[at + 1]]
            last[lone + 1] = first
        marked = np.zeros(len(codes) + 1, bool)
        place = begin + sizes
        while True:
            place = place[offset[np.minimum(place, len(offset) - 1)] > 0]
            if not len(place):
                break
            marked[place] = True
            token = last[place]
            place = place - np.where(token == first, 1, self.lengths[token])
        ends = np.flatnonzero(marked)
        token = last[ends]
        bytes_of = np.where(token == first, 1, 0)
        raw = {}
        for i in np.flatnonzero(token == first).tolist():
            raw[i] = self.byte_ids[list(text[ends[i] - 1].encode())].tolist()
            bytes_of[i] = len(raw[i])
        size = np.maximum(bytes_of, 1)
        out = np.repeat(self.ids[np.maximum(token, 0)], size)
        behind = np.cumsum(size)
        for i, ids in raw.items():
            out[behind[i] - len(ids) : behind[i]] = ids
        return as_runs(out, np.bincount(word[ends - 1], size, len(segments)).astype(np.int64))

    def encode_keys(self, keys: list[str]) -> list[bytes]:
        """Ids of the segments with these keys, some ``INDEX`` characters at a time."""
        out: list[bytes] = []
        segments = [segment_of(k) for k in keys]
        for a, b in chunks(segments, INDEX):
            out += self.encode(segments[a:b])
        return out


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Decoder:
    """Texts from ids."""

    def __init__(self, path: str):
        import sentencepiece as sp

        model = sp.SentencePieceProcessor(model_file=path)
        self.table = [
            bytes([int(model.id_to_piece(i)[3:5], 16)])
            if model.is_byte(i)
            else b""
            if model.is_control(i)
            else model.id_to_piece(i).replace(SIGN, " ").encode()
            for i in range(model.get_piece_size())
        ]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.table.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text[:1] == " " else text


def encode_texts(texts: list[str], memo: WordMemo) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts end to end, and how many each has."""
    keys = [segment_keys(t) for t in texts]
    counts = np.fromiter(map(len, keys), np.int64, len(keys))
    ids, lengths = memo.ids(memo.slots([k for ks in keys for k in ks]))
    return ids, sums_by_text(lengths, counts)


@lru_cache(maxsize=1)
def _memo(path: str) -> WordMemo:
    """One for each worker process, so that its later tasks find the segments of its earlier ones."""
    return WordMemo(vocabulary(path).encode_keys, REMEMBERED)


def _encode_batches(path: str, key: str):
    """A function for ``mapInArrow``: ids of the texts and whether they decode to the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, decoder = _memo(path), Decoder(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts, CHUNK):
                ids, counts = encode_texts(texts[a:b], memo)
                ends = np.concatenate([[0], np.cumsum(counts)])
                flat = ids.tolist()
                same = [
                    decoder.decode(flat[i:j]) == t
                    for t, i, j in zip(texts[a:b], ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(a, b - a), pa.array(counts, pa.int64()), lists, pa.array(same)],
                    names=[key, "n_tokens", "ids", "roundtrip"],
                )

    return run


def _decode_batches(path: str, column: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in batches:
            texts = [None if ids is None else decoder.decode(ids) for ids in batch.column(column).to_pylist()]
            keep = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string())], names=[*names, "text"])

    return run


def encoded(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``key``, n_tokens, ids and roundtrip for each row of ``docs`` (``key``, text)."""
    rows = docs.select(F.col(key), whole_text().alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(
        returning(_encode_batches(path, key)), f"`{key}` {kind}, n_tokens long, ids array<int>, roundtrip boolean"
    )


def decoded(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``rows`` with the text of the ids in ``column`` in its place."""
    fields = [(f.name, f.dataType.simpleString()) for f in rows.schema if f.name not in (column, "text")]
    names = [n for n, _ in fields]
    some = rows.select(*(F.col(f"`{n}`") for n in names), column)
    return some.mapInArrow(
        _decode_batches(path, column, names), ", ".join([*(f"`{n}` {k}" for n, k in fields), "text string"])
    )


def op1_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Ids of every document by the piece model at ``path``."""
    return encoded(documents(spark, sf_dir), path or public_tokenizers.path(MODEL))
