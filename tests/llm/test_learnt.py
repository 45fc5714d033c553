"""Operators 3 and 6 on held-out rows, and the pipeline."""

import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gatetally.llm import language, quality, toxicity
from gatetally.llm.registry import ORACLE_SQL, QUERIES

from .conftest import SCHEMA


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    syllables = ["ba", "de", "ki", "lo", "mu", "ne", "ri", "so", "ta", "vu"]
    plain = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(600):
        words = [plain() for _ in range(rng.randint(40, 90))]
        toxic = int(i % 3 == 0)
        if toxic:
            for _ in range(6):
                words[rng.randrange(len(words))] = "zorg" + rng.choice(syllables)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, toxic))
    rows += [(1000, None, "en", "s", 1), (1001, "", "en", "s", 1), (None, "zorgba " * 30, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, labelled):
    docs, labels = labelled
    out = toxicity.toxicity(docs.withColumn("score", F.lit(3)), labels).collect()
    assert len(out) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in out if r["doc_id"] in truth and r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)


def test_toxicity_does_not_learn_from_held_out_labels(spark, labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    both = [{r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, x).collect()} for x in (labels, turned)]
    assert both[0] == both[1]


def test_toxicity_learns_from_every_labelled_row(spark, labelled):
    """The rarer class does not limit what is learnt of the other one."""
    docs, labels = labelled
    model, _ = toxicity.learn(docs, labels)
    used = docs.join(labels, "doc_id").where(~toxicity.held_out(F.col("doc_id")))
    words = {r["toxic"]: r["n"] for r in used.groupBy("toxic").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    # Strings that begin a word are counted as they are, so the blank's total is the number of words.
    assert [model.value.own[0].contexts.values[c].max() for c in (0, 1)] == [words[0], words[1]]


def test_toxicity_without_labels(spark, labelled, empty):
    docs, labels = labelled
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_language_of_pages(spark):
    rng = random.Random(2)
    kinds = {"aa": ["lor", "mip", "tak"], "bb": ["zön", "quu", "ebb"]}
    text = lambda k, n: " ".join("".join(rng.choices(kinds[k], k=2)) for _ in range(n))
    docs = spark.createDataFrame([(i, text(k, 40), k, "s", 1) for i in range(60) for k in [("aa", "bb")[i % 2]]], SCHEMA)
    pages = []
    for i in range(80):
        k = ("aa", "bb")[i % 2]
        body = "" if i in (10, 11) else text(k, 30)
        lang = "" if i % 5 == 0 else f' lang="{k}-X"'
        pages.append((i, f"https://host{i % 2}.example.{k}/p?x", f"<html{lang}><script>tak</script><p>{body}</p></html>"))
    pages += [(80, None, None), (81, "nonsense", ""), pages[3]]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("lang", F.lit("zz"))
    out = language.languages(df, docs).collect()
    assert len(out) == 83
    for r in out:
        if r["page_id"] < 80:  # pages without text are told by markup, suffix and host
            assert r["lang"] == ("aa", "bb")[r["page_id"] % 2] and r["probability"] > 0.5
    assert language.languages(df.limit(0), docs).count() == 0
    assert {r["lang"] for r in language.languages(df, docs.limit(0)).collect()} == {None}


def test_registry_is_whole():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


def test_pipeline_stages(spark, corpus, sf_dir):
    docs = corpus
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        if name != "sentencepiece":
            assert docs.columns == corpus.columns
        counts.append(docs.count())
    assert counts[1] == quality.kept_rows(corpus).count()
    assert counts[0] > counts[1] > counts[2] == counts[3] >= counts[4] == counts[5] > 0
    assert docs.columns == ["doc_id", "n_tokens", "ids", "roundtrip"]
    assert docs.where("n_tokens <> size(ids)").count() == 0


def test_toxicity_remembers_words_from_task_to_task(monkeypatch):
    """A worker asks the model once for each word, however many tasks it runs."""
    asked = []

    def ratios(self, letters):
        n = int(letters.word[-1]) + 1 if len(letters.word) else 0
        asked.append(n)
        return np.full(n, 2.0)

    monkeypatch.setattr(toxicity.Model, "ratios", ratios)
    score = toxicity._scores(SimpleNamespace(value=toxicity.Model([], [])), (1.0, 0.0), "doc_id")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["one two", "", "two three two"]})
    first, second = ([b.to_pydict() for b in score(iter([batch]))] for _ in range(2))
    assert sum(asked) == 3
    assert first == second
    assert first[0]["mean_llr"] == [2.0, 0.0, 2.0]


def test_toxicity_counts_symbols_of_unlabelled_rows(spark, labelled):
    """The pass that counts the words of the classes also gives the shared counts."""
    docs, labels = labelled
    model, _ = toxicity.learn(docs, labels.where(F.col("doc_id") < 100))
    # Symbols counted over all documents, labelled or not: the letters of all words, and a blank behind each.
    symbols = docs.where(F.length("text") > 0).agg(F.sum(F.length(F.trim("text")) + 1)).first()[0]
    assert model.value.shared[0].contexts.values[0].max() == symbols


def test_table_finds_each_key_and_no_other():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 1000):
        keys = np.unique(np.append(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False), np.uint64(0) if n > 2 else []).astype(np.uint64))
        values = rng.random(len(keys))
        table = toxicity.Table(keys.view(np.int64), values)
        top = np.array([(1 << 64) - 1], np.uint64)
        asked = np.concatenate([keys, keys + np.uint64(1), top])
        known = dict(zip(keys.tolist(), values.tolist(), strict=True))
        assert table.values[0][table.find(asked)].tolist() == [known.get(k, 0.0) for k in asked.tolist()]
