"""Token ids in segments with Elias-Fano document boundaries (operator 9).

The file format is a folder of Parquet files, which any store that Spark reads
can hold. A row is one segment: the ids of consecutive documents end to end, as
little-endian integers of 2 or 4 bytes (whatever the vocabulary needs), and the
ends of the documents as an Elias-Fano sequence: ``floor(log2(ids / documents))``
low bits of each end packed, the high bits in unary as a bit vector, and the
place of every 256th set bit of it for selection. That takes about
``2 + log2(ids / documents)`` bits a document instead of 64.

Documents are cut into ranges of doc_id, sorted and encoded, one task for each
range; a segment closes once it holds ``SEGMENT_IDS`` ids. The number of ids
before a segment is its offset in its range (stored) plus the totals of earlier
ranges (one row for each range).

Words are found by 64-bit hashes of their bytes, and the library encodes each
word once in a while: a worker remembers ``REMEMBERED`` of them. Words with equal
hashes would count as equal (one pair in about 2^64).

Defined results: null and empty texts have the end id alone; a null doc_id sorts
first; rows with equal doc_id follow each other by checksum of the text; an empty
table gives empty files; other columns are ignored; a text is never split.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gatetally.llm.bytehash import Hashed, class_table, joined, lowered, runs
from gatetally.llm.shared import documents, shared_folder, whole_text
from gatetally.llm.wordmemo import HashMemo, as_runs, chunks, sums_by_text

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: A segment closes once it holds this many ids.
SEGMENT_IDS = 1 << 20
#: Every so many set bits of the high bits, the place of one is stored.
SAMPLE = 256
#: Words that the library encodes as one line.
JOINED = 256
#: Words whose ids a worker remembers (about 60 bytes each).
REMEMBERED = 800_000

SEGMENT_SCHEMA = """part int, segment int, ids_before long, n_docs int, n_ids long, id_bytes int, low_bits int,
    low binary, high binary, samples binary, ids binary, doc_ids array<long>"""


class EliasFano:
    """A non-decreasing sequence of integers up to ``universe``, with ``select``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples = low, high, np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        low = (values[:, None] >> np.arange(low_bits)) & 1
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros(n + (universe >> low_bits) + 1, np.uint8)
        high[places] = 1
        pack = lambda bits: np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(n, low_bits, pack(low), pack(high), places[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: int, count: int) -> np.ndarray:
        first = i * self.low_bits
        raw = np.frombuffer(self.low, np.uint8)[first // 8 : (first + count * self.low_bits + 7) // 8]
        bits = np.unpackbits(raw, bitorder="little")[first % 8 :][: count * self.low_bits]
        return bits.reshape(count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value, read from the nearest sample on."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8, 1, byte), bitorder="little")
        bits[: place % 8] = 0
        left += 1
        while True:
            ones = int(bits.sum())
            if ones >= left:
                place = byte * 8 + int(np.flatnonzero(bits)[left - 1])
                break
            left -= ones
            byte += 1
            bits = np.unpackbits(np.frombuffer(self.high, np.uint8, 1, byte), bitorder="little")
        return ((place - i) << self.low_bits) + int(self._low(i, 1)[0])

    def values(self) -> np.ndarray:
        """All values."""
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        return (high << self.low_bits) + self._low(0, self.n)


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Fixed value: how the vocabulary marks the last piece of a word.
_END = "</w>"
#: Bytes of marks that may follow a word, and those before them that show the end of a letter or digit.
_MARK = class_table(b".,;:!?%$#&*")
_PLAIN = class_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
#: Second bytes of the Latin letters whose first byte is 0xC3 (all but the signs for times and divided by).
_ACCENTED = class_table(bytes({*range(0x80, 0xC0)} - {0x97, 0xB7}))


def units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what is encoded on its own: words between blanks, with the marks behind a letter or digit cut off.

    The tokenizer splits at blanks, and between letters or digits and marks.
    """
    starts, ends = runs((data != 32) & (data != 10))
    solid = np.maximum.accumulate(np.where(_MARK[data], 0, np.arange(1, len(data) + 1)))
    cut = solid[ends - 1]
    before = data[cut - 1]
    inside = _PLAIN[before] | ((cut - 2 >= starts) & (data[cut - 2] == 0xC3) & _ACCENTED[before])
    cut = cut[(cut < ends) & (cut > starts) & inside]
    # The parts do not overlap, so sorted starts and sorted ends belong together.
    return np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))


def _encoder(path: str):
    """Encodes distinct words; the library sees words of Latin letters in lines of many."""
    tokenizer = _tokenizer(path)
    vocabulary = tokenizer.get_vocab()
    closing = np.zeros(max(vocabulary.values()) + 1, bool)
    closing[[i for piece, i in vocabulary.items() if piece.endswith(_END)]] = True

    def encode(words: list[str]) -> list[bytes]:
        found: dict[str, bytes] = {}
        plain, other = [], []
        for word in words:
            (plain if word.isalpha() and (word.isascii() or max(word) <= "ÿ") else other).append(word)
        for at in range(0, len(plain), 256 * JOINED):
            some = plain[at : at + 256 * JOINED]
            lines = [" ".join(some[i : i + JOINED]) for i in range(0, len(some), JOINED)]
            encoded = tokenizer.encode_batch_fast(lines, add_special_tokens=False)
            flat = np.fromiter(chain.from_iterable(f.ids for f in encoded), np.int32)
            # Letters alone are one word to the tokenizer, whose last piece is marked.
            after = np.flatnonzero(closing[flat]) + 1
            found.update(zip(some, as_runs(flat, np.diff(after, prepend=0)), strict=True))
        for at in range(0, len(other), 4096):
            some = other[at : at + 4096]
            encoded = tokenizer.encode_batch_fast(some, add_special_tokens=False)
            found.update((word, np.array(f.ids, np.int32).tobytes()) for word, f in zip(some, encoded, strict=True))
        return [found[word] for word in words]

    return encode


@lru_cache(maxsize=1)
def _memo(path: str) -> HashMemo:
    """One for each worker process, so that its later tasks find the words of its earlier ones."""
    return HashMemo(_encoder(path), REMEMBERED)


def id_width(path: str) -> int:
    """Bytes that hold any id of the vocabulary and the end id."""
    return 2 if _tokenizer(path).get_vocab_size() <= 1 << 16 else 4


def encode_texts(texts: list[str], memo: HashMemo, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, each closed by ``end_id``, end to end; and how many each text has."""
    data, at = joined(texts)
    raw = data.tobytes()
    if b"<|" not in raw:  # special strings are in lower case, all others are lowered by the tokenizer
        data = lowered(data)
        raw = data.tobytes()
    starts, ends = units(data)
    hashes = Hashed(data).spans(starts, ends)

    def words(places: np.ndarray) -> list[str]:
        return [raw[a:b].decode() for a, b in zip(starts[places].tolist(), ends[places].tolist(), strict=True)]

    ids, lengths = memo.ids(memo.slots(hashes, words))
    n = sums_by_text(lengths, np.diff(np.searchsorted(starts, at)))
    ends = np.cumsum(n + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.int64)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids
    return out, n + 1


def write_batches(path: str, end_id: int, segment_ids: int):
    """A function for ``mapInArrow`` from sorted documents to segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, width = _memo(path), id_width(path)
        part = TaskContext.get().partitionId()
        segment = before = held = 0
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names: list = []
        schema = pa.schema(
            [("part", pa.int32()), ("segment", pa.int32()), ("ids_before", pa.int64()), ("n_docs", pa.int32())]
            + [("n_ids", pa.int64()), ("id_bytes", pa.int32()), ("low_bits", pa.int32()), ("low", pa.binary())]
            + [("high", pa.binary()), ("samples", pa.binary()), ("ids", pa.binary())]
            + [("doc_ids", pa.list_(pa.int64()))]
        )

        def close() -> pa.RecordBatch:
            ends = np.cumsum(np.concatenate(counts))
            total = int(ends[-1])
            ef = EliasFano.of(ends, total)
            raw = np.concatenate(ids).astype(f"<u{width}").tobytes()
            row = [part, segment, before, len(ends), total, width, ef.low_bits, ef.low, ef.high]
            row += [ef.samples.tobytes(), raw, names]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for first, last in chunks(texts):
                some, n = encode_texts(texts[first:last], memo, end_id)
                ids.append(some)
                counts.append(n)
                names += keys[first:last]
                held += len(some)
                if held >= segment_ids:
                    yield close()
                    segment, before, held = segment + 1, before + held, 0
                    ids, counts, names = [], [], []
        if names:
            yield close()

    return run


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments to one row for each document."""
    for batch in batches:
        for row in batch.to_pylist():
            ends = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"]).values()
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4").tobytes()
            sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["ids_before"] + row["range_start"], pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def write_token_ids(
    docs: DataFrame, folder: str, path: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS
) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending order of doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    tie = F.crc32(F.col("text").cast("binary"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie.asc())
    in_order = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie.asc())
    in_order.mapInArrow(write_batches(path, end_id, segment_ids), SEGMENT_SCHEMA).write.parquet(folder)


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document of a folder: its first id's place, number of ids and their checksum."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(folder)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("range_start"))
    # One row for each task that wrote: that bounds the broadcast side.
    placed = segments.join(F.broadcast(ranges), "part")
    return placed.mapInArrow(read_batches, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_ids(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents encoded, written, and read back."""
    folder = shared_folder(spark, "token-ids")
    write_token_ids(documents(spark, sf_dir), folder, path or public_tokenizers.path(TOKENIZER))
    return read_token_ids(spark, folder)
