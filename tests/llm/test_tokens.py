"""Operators 1, 9 and 10 against their libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gatetally.llm import bpe_counts, sentencepiece_sa, token_ids
from gatetally.llm.shared import shared_folder

from .conftest import rows_of

PIECES = public_tokenizers.path(bpe_counts.MODEL)
WORDS = public_tokenizers.path(token_ids.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_sentencepiece_equals_the_library_and_decodes(corpus, library):
    found = sentencepiece_sa.encoded(corpus, PIECES).join(corpus.select("doc_id"), "doc_id", "left").collect()
    texts = {}
    for r in corpus.collect():
        texts.setdefault(r["doc_id"], set()).add(tuple(library.encode(r["text"] or "")))
    for r in found:
        assert tuple(r["ids"]) in texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
    back = sentencepiece_sa.decoded(sentencepiece_sa.encoded(corpus, PIECES), PIECES)
    want = [(r["doc_id"], library.decode(library.encode(r["text"] or ""))) for r in corpus.collect()]
    assert rows_of(back, "doc_id", "text") == sorted(want, key=repr)


@pytest.mark.parametrize(
    "text", ["", " ", "  a", "a ", "a  b", "\n", "\n\nfoo", "a \n b", "▁a▁▁b", "a" * 70, " " * 40, "<unk></s>é\x01"]
)
def test_pieces_of_odd_texts(text, library):
    vocabulary = sentencepiece_sa.vocabulary(PIECES)
    memo = sentencepiece_sa.WordMemo(vocabulary.encode_keys, 50)
    assert sentencepiece_sa.encode_texts([text], memo)[0].tolist() == library.encode(text)


def test_counts_equal_the_library(corpus, library):
    rows = corpus.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = bpe_counts.with_token_counts(rows, PIECES)
    want = [(r["doc_id"], len(library.encode(r["text"] or ""))) for r in corpus.collect()]
    assert rows_of(found, "doc_id", "n_tokens") == sorted(want, key=repr)


def test_token_files_read_back(spark, corpus):
    folder = shared_folder(spark, "ids")
    token_ids.write_token_ids(corpus, folder, WORDS, segment_ids=500)
    found = token_ids.read_token_ids(spark, folder).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    rows = [(r["doc_id"], r["text"] or "") for r in corpus.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].encode())))
    start = 0
    for r, (doc, text) in zip(found, rows, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, token_ids.END_ID]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc, start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_elias_fano_selects():
    rng = np.random.default_rng(3)
    for n, top in ((1, 0), (1, 9), (700, 40), (900, 10**7)):
        values = np.sort(rng.integers(0, top + 1, n))
        ef = token_ids.EliasFano.of(values, top)
        again = token_ids.EliasFano(n, ef.low_bits, ef.low, ef.high, ef.samples.tobytes())
        assert again.values().tolist() == values.tolist()
        assert [again.select(i) for i in range(0, n, 7)] == values[::7].tolist()


def test_empty_tables(spark, empty):
    assert sentencepiece_sa.encoded(empty, PIECES).count() == 0
    assert bpe_counts.with_token_counts(empty.select("doc_id", "text"), PIECES).count() == 0
    folder = shared_folder(spark, "ids")
    token_ids.write_token_ids(empty, folder, WORDS)
    assert token_ids.read_token_ids(spark, folder).count() == 0


@pytest.mark.parametrize("limit", [60, 100_000])
def test_words_by_hash_equal_the_library(limit):
    """Marks behind words, special strings, accents and other scripts; a memo that must forget changes nothing."""
    rng = random.Random(limit)
    alphabet = [*"abAB1.,;:!?%$#&*'\" \n\t<|>éÉß×÷ñ\u0301İſ日½_-\xa0", "endoftext", "<|endoftext|>", "<|ENDOFTEXT|>", "'s"]
    texts = ["", " ", ".", "a...b", "x\".", "×.", "A.\u0300", "word " * 40_000]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(3000)]
    tokenizer = token_ids._tokenizer(WORDS)
    memo = token_ids.HashMemo(token_ids._encoder(WORDS), limit)
    for at in range(0, len(texts), 53):
        some = texts[at : at + 53]
        ids, n = token_ids.encode_texts(some, memo, token_ids.END_ID)
        ends = n.cumsum()
        for text, first, last in zip(some, ends - n, ends, strict=True):
            wanted = [*tokenizer.encode(text, add_special_tokens=False).ids, token_ids.END_ID]
            assert ids[first:last].tolist() == wanted
