"""Byte-level BPE through a global shuffle of distinct words (operator 12).

Encoding. Texts are taken in runs of about ``RUN_CHARS`` characters, one run at a
time. The pre-tokens of a run (matches of the pattern, with their positions) are
reduced to its distinct words, numbered as they first come, and the word number at
every position. The distinct words go to the bucket of their hash, those of one run and
bucket packed in one row; there each distinct word of the whole input is merged
once, and its ids go back to every run that holds it. A run's numbers and its words'
ids meet again by run, and the ids are gathered by position. What crosses the
network is each distinct word of a run, never a word for each time it occurs, so a
frequent word is a few bytes for each run.

The runs are cut twice, once for the words and once for the positions, from the
same rows; a run carries a checksum of its words, and reassembly fails rather than
mix runs that differ. So the rows must come in one order each time a partition is
computed, as they do from files; write other frames first (``shared.stored``).

Decoding joins every id with the table of token bytes, whose size is that of the
vocabulary, and concatenates the bytes in order.

Memory: a run's texts, its distinct words, some bytes for each pre-token; in the
shuffle the distinct words of one bucket, of which there are ``PER_PARTITION`` for
each shuffle partition, so that setting bounds them. A text is never split, so the
longest text bounds a run too.

Defined results: null and empty texts have no ids; repeated rows and equal or null
doc_ids are encoded each for itself; an empty table gives no rows; other columns
are ignored; special strings inside texts are ordinary text.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally.llm.bpe_counts import merged
from gatetally.llm.shared import documents, ship, whole_text

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of a run of texts; a run closes once it holds this many.
RUN_CHARS = 1 << 22
#: Buckets of words for each shuffle partition.
PER_PARTITION = 4
#: Ids that are decoded at a time.
VALUES = 1 << 20

#: Where a text may be cut: a space before something else than white space starts a match.
_CUT = regex.compile(r" (?=\S)")
#: Texts without this hold single spaces only; it may find more than the pattern's white space, never less.
_ODD = re.compile(r" (?:\s|\Z)")


class Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def segment_keys(text: str) -> list[str]:
    """The parts of ``text`` between cuts, each without the space that leads it.

    The first part has no such space and is marked by one; no other starts with one.
    """
    parts = _CUT.split(text) if _ODD.search(text) else text.split(" ")
    parts[0] = " " + parts[0]
    return parts


def pieces_of(key: str, matches) -> list[str]:
    """The pre-tokens of a segment."""
    if key.isalpha():
        return [" " + key]
    return matches(key[1:] if key[0] == " " else " " + key)


def words_of(segments: Iterable[str], matches) -> tuple[Numbers, list[list[int]]]:
    """The pre-tokens of distinct segments numbered as they first come, and their numbers for each segment."""
    words = Numbers()
    return words, [[words[p] for p in pieces_of(key, matches)] for key in segments]


def distinct_words(texts: list[str], matches) -> list[bytes]:
    """The distinct pre-tokens of a run by number; frequent ones tend to come first."""
    segments: dict[str, None] = {}
    for text in texts:
        if text:
            segments |= dict.fromkeys(segment_keys(text))
    return [w.encode() for w in words_of(segments, matches)[0]]


def numbered(texts: list[str], matches) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The same words, the number of that at every position, and how many positions each text has."""
    segments = Numbers()
    at, counts = [], []
    for text in texts:
        keys = segment_keys(text) if text else []
        at.append(np.fromiter(map(segments.__getitem__, keys), np.int32, len(keys)))
        counts.append(len(keys))
    words, found = words_of(segments, matches)
    places = np.concatenate(at)
    lists = pa.array(found, pa.list_(pa.int32())).take(pa.array(places))
    return [w.encode() for w in words], lists.flatten().to_numpy(), list_lengths(lists, np.array(counts, np.int64))


def list_lengths(lists: pa.ListArray, counts: np.ndarray) -> np.ndarray:
    """How many values the lists hold, for each stretch of ``counts`` lists."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(lists.offsets.to_numpy()[ends])


def squeezed(numbers: np.ndarray, *more: bytes) -> bytes:
    """32-bit numbers, their bytes by significance, and further bytes, compressed: small numbers leave zeros."""
    raw = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    body = b"".join((len(numbers).to_bytes(8, "little"), raw, *more))
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unsqueezed(raw: bytes) -> tuple[np.ndarray, bytes]:
    """The numbers, and the further bytes."""
    body = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    n = int.from_bytes(body[:8], "little")
    numbers = np.ascontiguousarray(np.frombuffer(body, np.uint8, 4 * n, 8).reshape(4, n).T).view("<u4").ravel()
    return numbers, body[8 + 4 * n :]


def packed(parts: list[bytes]) -> bytes:
    """Byte strings as one: their lengths, and the strings end to end."""
    return squeezed(np.fromiter(map(len, parts), np.int64, len(parts)), *parts)


def runs_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list, list[str]]]:
    """(number, doc_ids, texts) of every run of a task."""
    docs, texts, held, number = [], [], 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            docs.append(doc.as_py())
            texts.append(text.as_py())
            held += len(texts[-1]) + 1
            if held >= size:
                yield number, docs, texts
                docs, texts, held, number = [], [], 0, number + 1
    if docs:
        yield number, docs, texts


def seal_of(words: list[bytes]) -> int:
    return zlib.crc32(b"\0".join(words))


_WORDS = "run long, seal long, bucket int, numbers binary, words binary"
_IDS = "run long, seal long, bucket int, numbers binary, ids binary"
_POSITIONS = "run long, seal long, bucket int, numbers binary, doc_ids array<long>, counts array<long>"


def word_rows(pattern: str, size: int, buckets: int):
    """For ``mapInArrow``: the distinct words of every run with their numbers, a row for each bucket of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = regex.compile(pattern).findall
        for number, _, texts in runs_of(batches, size):
            words = distinct_words(texts, matches)
            bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            spans = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(spans), pa.int64()),
                    pa.array([seal_of(words)] * len(spans), pa.int64()),
                    pa.array([int(bucket[order[a]]) for a, _ in spans], pa.int32()),
                    pa.array([squeezed(np.diff(order[a:b], prepend=0)) for a, b in spans], pa.binary()),
                    pa.array([packed([words[i] for i in order[a:b]]) for a, b in spans], pa.binary()),
                ],
                names=["run", "seal", "bucket", "numbers", "words"],
            )

    return run


def position_rows(pattern: str, size: int):
    """For ``mapInArrow``: the documents of every run and the word number at each of their positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = regex.compile(pattern).findall
        for number, docs, texts in runs_of(batches, size):
            words, numbers, counts = numbered(texts, matches)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([seal_of(words)], pa.int64()),
                    pa.array([-1], pa.int32()),
                    pa.array([squeezed(numbers)], pa.binary()),
                    pa.array([docs], pa.list_(pa.int64())),
                    pa.array([counts.tolist()], pa.list_(pa.int64())),
                ],
                names=["run", "seal", "bucket", "numbers", "doc_ids", "counts"],
            )

    return run


@lru_cache(maxsize=1)
def ranks_of(path: str) -> dict[str, int]:
    """The ranks of a file by the bytes of the token, each byte written as one character."""
    with open(path, "rb") as file:
        rows = [line.split() for line in file if line.strip()]
    return {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in rows}


@lru_cache(maxsize=1)
def token_bytes(path: str) -> pa.Array:
    """The bytes of each id; ids that are no token have none."""
    ranks = ranks_of(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token.encode("latin-1")
    return pa.array(table, pa.large_binary())


def id_bytes(path: str) -> int:
    """Bytes of an id between tasks."""
    return 2 if len(token_bytes(path)) <= 1 << 16 else 4


def word_ids(word: bytes, ranks: dict[str, int]) -> list[int]:
    """The ids of one pre-token: itself, or what is left after merging its bytes by rank."""
    raw = word.decode("latin-1")
    whole = ranks.get(raw)
    return [whole] if whole is not None else [ranks[s] for s in merged(raw, ranks)[0]]


def encode_words(path: str):
    """For ``mapInArrow``: rows sorted by bucket get ids for words; a bucket's distinct words are merged once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, here, known = ranks_of(path), None, {}
        small = id_bytes(path) == 2
        for batch in batches:
            out = []
            for bucket, raw in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if bucket != here:
                    here, known = bucket, {}
                lengths, joined = unsqueezed(raw)
                ends = np.cumsum(lengths, dtype=np.int64)
                words = [joined[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                for word in set(words).difference(known):
                    known[word] = array("H" if small else "I", word_ids(word, ranks)).tobytes()
                out.append(packed([known[w] for w in words]))
            kept = [batch.column(c) for c in ("run", "seal", "bucket", "numbers")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(out, pa.binary())], names=["run", "seal", "bucket", "numbers", "ids"]
            )

    return run


def assemble(path: str):
    """For ``mapInArrow``: rows sorted by run and bucket, a run's positions first, to the ids of each document."""
    changed = "the rows of a run changed between two readings; store the frame first"

    def ids_of(head: dict, found: list[tuple[bytes, bytes]], width: int) -> pa.RecordBatch:
        at = unsqueezed(head["numbers"])[0]
        parts = [(np.cumsum(unsqueezed(n)[0], dtype=np.int64), *unsqueezed(raw)) for n, raw in found]
        numbers = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
        need = int(at.max()) + 1 if len(at) else 0
        place = np.full(need, -1)
        if len(numbers) == need:
            place[numbers] = np.arange(need)
        if (place < 0).any() or len(numbers) != need:
            raise RuntimeError(changed)
        sizes = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)]) // width
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = np.frombuffer(b"".join(p[2] for p in parts), f"<u{width}").astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)).take(pa.array(place[at]))
        counts = list_lengths(lists, np.array(head["counts"], np.int64))
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), lists.flatten())
        return pa.RecordBatch.from_arrays([pa.array(head["doc_ids"], pa.int64()), ids], names=["doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, found, width = None, [], id_bytes(path)
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["bucket"] < 0:
                    if head is not None:
                        yield ids_of(head, found, width)
                    head, found = row, []
                elif head is None or (row["run"], row["seal"]) != (head["run"], head["seal"]):
                    raise RuntimeError(changed)
                else:
                    found.append((row["numbers"], row["ids"]))
        if head is not None:
            yield ids_of(head, found, width)

    return run


def encoded(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, run_chars: int = RUN_CHARS
) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text) by the ranks at ``path``."""
    spark = docs.sparkSession
    ship(spark)
    buckets = PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    words = rows.mapInArrow(word_rows(pattern, run_chars, buckets), _WORDS)
    ids = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(encode_words(path), _IDS)
    positions = rows.mapInArrow(position_rows(pattern, run_chars), _POSITIONS)
    met = positions.unionByName(ids, allowMissingColumns=True).repartition("run")
    return met.sortWithinPartitions("run", "bucket").mapInArrow(assemble(path), "doc_id long, ids array<int>")


def joined(lists: pa.ListArray, table: pa.Array) -> list[memoryview]:
    """For each list of ids the entries of ``table`` end to end; a null list has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    texts = table.take(lists.flatten())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return [memoryview(b"")] * len(lists)
    ends = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)[np.concatenate([[0], np.cumsum(sizes)])]
    whole = memoryview(data) if data is not None else memoryview(b"")
    return [whole[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Rows of ``batch`` with about ``VALUES`` values in their lists at a time."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    edges = [*np.flatnonzero(np.diff(np.cumsum(sizes) // VALUES, prepend=-1)).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)


def decode_batches(path: str, column: str, out: str):
    """For ``mapInArrow``: the bytes of the ids in ``column``, joined with the table of token bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            for some in slices(batch, column):
                texts = pa.array([bytes(t) for t in joined(some.column(column), table)], pa.binary())
                kept = [(n, c) for n, c in zip(some.schema.names, some.columns, strict=True) if n != out]
                yield pa.RecordBatch.from_arrays([*(c for _, c in kept), texts], names=[*(n for n, _ in kept), out])

    return run


def decoded(rows: DataFrame, path: str, column: str = "ids", out: str = "bytes") -> DataFrame:
    """``rows`` with the bytes that the ids in ``column`` (null: none) stand for as ``out``."""
    ship(rows.sparkSession)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != out]
    return rows.mapInArrow(decode_batches(path, column, out), ", ".join([*fields, f"`{out}` binary"]))


@lru_cache(maxsize=1)
def decimals(path: str) -> pa.Array:
    """Each id as a decimal with a space behind it."""
    return pa.array([b"%d " % i for i in range(len(token_bytes(path)))], pa.large_binary())


def digest_batches(path: str):
    """From (doc_id, ids, bytes) to the digests of ids (decimal, one space between them) and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decimals(path)
        for batch in batches:
            ids = batch.column("ids")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.list_value_length(ids).cast(pa.int64()),
                    pa.array([sha256(t[:-1]).hexdigest() for t in joined(ids, table)], pa.string()),
                    pa.array([sha256(raw.as_buffer()).hexdigest() for raw in batch.column("bytes")], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def op12_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document encoded and decoded again by the ranks at ``path``."""
    path = path or public_tokenizers.path(RANKS)
    codes = encoded(documents(spark, sf_dir), path)
    back, told = decode_batches(path, "ids", "bytes"), digest_batches(path)
    # Decoding and digests in one pass: the bytes need not return to the JVM in between.
    return codes.mapInArrow(
        lambda batches: told(back(batches)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
