"""Token counts by byte-pair merging with a heap and a linked list (operator 10).

Symbols of a segment form a doubly linked list; a heap holds every adjacent pair
whose concatenation is a piece. The lowest rank is popped again and again (the
leftmost first among equal ranks) and its two symbols become one. A segment has
as many tokens as initial symbols minus merges, so no identifier is made. A
character that is no piece falls back to one symbol for each of its bytes.

Segments repeat, so a worker merges each distinct one once and keeps its count, up
to a fixed number of segments (see ``wordmemo``).

Defined results: null and empty texts have no tokens; repeated rows are counted
each for itself; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally.llm.segments import segment_keys, segment_of
from gatetally.llm.shared import documents, whole_text
from gatetally.llm.wordmemo import WordMemo, as_runs, chunks, sums_by_text

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Segments whose counts a worker remembers (about 150 bytes each).
REMEMBERED = 1_000_000


@lru_cache(maxsize=2)
def piece_ranks(path: str) -> dict[str, int]:
    """Ranks of the ordinary pieces of a model file: the best score has rank 0, equal scores share one."""
    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=path)
    plain = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    scores = sorted({model.get_score(i) for i in plain}, reverse=True)
    rank = {s: r for r, s in enumerate(scores)}
    return {model.id_to_piece(i): rank[model.get_score(i)] for i in plain}


def merged(text: str, ranks: dict[str, int]) -> tuple[list[str], int]:
    """The symbols of ``text`` after all merges, and how many merges there were."""
    symbols = list(text)
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        pair = symbols[i] + symbols[i + 1]
        rank = ranks.get(pair)
        if rank is not None:
            heap.append((rank, i, pair))
    heapify(heap)
    merges = 0
    while heap:
        _, i, pair = heappop(heap)
        left = symbols[i]
        j = after[i]
        # Symbols only grow or vanish, so a pair is current while its lengths add up.
        if not left or j >= n or len(left) + len(symbols[j]) != len(pair):
            continue
        symbols[i], symbols[j] = pair, ""
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            new = pair + symbols[k]
            rank = ranks.get(new)
            if rank is not None:
                heappush(heap, (rank, i, new))
        h = before[i]
        if h >= 0:
            new = symbols[h] + pair
            rank = ranks.get(new)
            if rank is not None:
                heappush(heap, (rank, h, new))
    return [s for s in symbols if s], merges


def token_count(text: str, ranks: dict[str, int]) -> int:
    """Initial symbols minus merges."""
    initial = sum(1 if c in ranks else len(c.encode()) for c in text)
    return initial - merged(text, ranks)[1]


@lru_cache(maxsize=1)
def _memo(path: str) -> WordMemo:
    """One for each worker process, so that its later tasks find the segments of its earlier ones."""
    ranks = piece_ranks(path)

    def counts(keys: list[str]) -> list[bytes]:
        found = [token_count(segment_of(k), ranks) for k in keys]
        return as_runs(np.array(found), np.ones(len(found), np.int64))

    return WordMemo(counts, REMEMBERED)


def count_batches(path: str, column: str, out: str):
    """A function for ``mapInArrow`` that puts token counts in place of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(path)
        for batch in batches:
            texts = batch.column(column).to_pylist()
            counts = []
            for first, last in chunks(texts):
                keys = [segment_keys(t) for t in texts[first:last]]
                lengths = np.fromiter(map(len, keys), np.int64, len(keys))
                slots = memo.slots([k for ks in keys for k in ks])
                counts.append(sums_by_text(memo.flat[memo.starts[slots]], lengths))
            at = batch.schema.get_field_index(column)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for n in batch.schema.names if n != column]
            counted = pa.array(np.concatenate(counts) if counts else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, counted], names=[*names, out])

    return run


def with_token_counts(rows: DataFrame, path: str, column: str = "text", out: str = "n_tokens") -> DataFrame:
    """``rows`` with the non-null ``column`` replaced by the number of its tokens."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != column]
    return rows.mapInArrow(count_batches(path, column, out), ", ".join([*fields, f"`{out}` long"]))


def op10_token_counts(
    spark: SparkSession, sf_dir: str, path: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """Tokens of every document by the piece model at ``path``."""
    text = whole_text()
    rows = documents(spark, sf_dir).select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    counted = with_token_counts(rows, path or public_tokenizers.path(MODEL))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
