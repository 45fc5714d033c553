"""Language of web pages by Bayesian fusion of evidence (operator 6).

For each page and language the logarithms of four terms are added:

* *text*: the mean log-likelihood of the byte trigrams of the visible text, times
  at most ``WEIGHT`` trigrams, as neighbouring trigrams are not independent;
* *declared*: how often pages of the language declare what this one's markup
  declares;
* *suffix*: how often pages of the language have this last part of the host name;
* *host*: the language shares of the host, smoothed towards those of its domain,
  which are smoothed towards those of all pages (``STRENGTH`` pages each).

Trigram counts come from at most ``SAMPLE`` documents of each language, those with
the smallest hash of their doc_id, and hold all of their trigrams and all labelled
languages. What is broadcast is one number for each language and trigram: at most
2^24 trigrams, and no more than the sample has. The counts of declarations, suffixes, domains and hosts are
sums of the text posteriors of all pages, by grouped aggregations with partial
sums; a page's own posterior is taken out of its host's and domain's counts. Only
rows of a few numbers are shuffled, never a page.

Defined results: a null or empty page has a flat text term; a missing declaration
or host is a value like any other; repeated rows are judged each for itself; ties
go to the language that is first by name; without labelled documents the language
is null and the probability 0; other columns are ignored; pages are read whole.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatetally.llm.bytehash import joined
from gatetally.llm.shared import documents, ship, stored, whole_text
from gatetally.llm.wordmemo import chunks

#: Most documents of a language that its trigrams are counted in.
SAMPLE = 1500
#: Trigrams that the text counts for at most, and pages that a prior counts for.
WEIGHT, STRENGTH = 60, 5.0
#: Added to each count.
SMOOTH = 0.5

_HIDDEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)")
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letter trigrams of the texts, and the number of each one's text."""
    # The blank before each text keeps its first letters from counting for the text before.
    data, at = joined([" " + t.lower() for t in texts])
    data = _LETTERS[data].astype(np.int32)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:] if len(data) > 2 else np.zeros(0, np.int32)
    text = np.repeat(np.arange(len(texts)), np.diff(at))[: len(code)]
    blank = data == 32
    use = ~(blank[1:-1] | (blank[:-2] & blank[2:])) if len(code) else np.zeros(0, bool)
    return code[use], text[use]


def visible(page: str) -> str:
    return entities.unescape(_HIDDEN.sub(" ", page))


def declared(page: str) -> str:
    found = _DECLARED.search(page)
    return found.group(1).lower() if found else ""


def host_of(url: str) -> str:
    found = _HOST.match(url)
    return found.group(1).lower().strip(".") if found else ""


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, kinds = batch.column("text").to_pylist(), np.array(batch.column("kind").to_pylist(), np.int64)
        for a, b in chunks(texts):
            code, text = trigrams(texts[a:b])
            key, n = np.unique((kinds[a:b][text] << 24) | code, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array((key >> 24).astype(np.int32)), pa.array((key & 0xFFFFFF).astype(np.int32)), pa.array(n)],
                names=["kind", "code", "n"],
            )


def learn(docs: DataFrame, sample: int = SAMPLE):
    """Names of the languages, the known trigrams and their log-probabilities by language."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    found = {r["lang"]: r["n"] for r in sizes.collect()}  # one row for each language
    names = sorted(found)
    if not names:
        return [], np.zeros(0, np.int64), np.zeros((0, 0))
    # Rows beyond this hash are not among the first of their language, or it has few rows.
    share = {name: min(1.0, (2 * sample + 1000) / n) for name, n in found.items()}
    spark = docs.sparkSession
    kinds = spark.createDataFrame(
        [(name, i, (2 * share[name] - 1) * 2.0**63) for i, name in enumerate(names)], "lang string, kind int, most double"
    )
    order = F.xxhash64("doc_id")
    early = labelled.select("doc_id", "lang").join(F.broadcast(kinds), "lang").where(order.cast("double") <= F.col("most"))
    turn = F.row_number().over(Window.partitionBy("kind").orderBy(order, "doc_id"))
    # At most ``sample`` rows for each language: that bounds the broadcast side.
    picked = F.broadcast(early.withColumn("turn", turn).where(F.col("turn") <= sample).select("doc_id", "kind").distinct())
    rows = docs.join(picked, "doc_id").select("kind", whole_text().alias("text"))
    counts = rows.mapInArrow(_count_batches, "kind int, code int, n long").groupBy("kind", "code").agg(F.sum("n").alias("n"))
    counted = counts.toArrow()
    kind, code, n = (counted.column(c).to_numpy() for c in ("kind", "code", "n"))
    codes = np.unique(code)
    logs = np.full((len(names), len(codes) + 1), SMOOTH, np.float32)
    logs[kind, np.searchsorted(codes, code)] += n
    logs = np.log(logs / logs.sum(1, keepdims=True, dtype=np.float64)).astype(np.float32)
    return names, codes, logs


def _page_batches(model, keep: str):
    """A function for ``mapInArrow``: host, declaration and weighted log-likelihoods of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, logs = model.value
        for batch in batches:
            pages, urls = batch.column("html").to_pylist(), batch.column("url").to_pylist()
            for a, b in chunks(pages):
                code, text = trigrams([visible(p) for p in pages[a:b]])
                at, n = np.searchsorted(codes, code), np.bincount(text, minlength=b - a)
                at[codes[np.minimum(at, len(codes) - 1)] != code] = len(codes)
                sums = np.stack([np.bincount(text, row[at], b - a) for row in logs], 1)
                scores = sums / np.maximum(n, 1)[:, None] * np.minimum(n, WEIGHT)[:, None]
                hosts = [host_of(u) for u in urls[a:b]]
                ends = pa.array(np.arange(0, scores.size + 1, max(1, scores.shape[1]))[: b - a + 1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(keep).slice(a, b - a),
                        pa.array(hosts, pa.string()),
                        pa.array([".".join(h.split(".")[-3:]) for h in hosts], pa.string()),
                        pa.array([h.rpartition(".")[2] for h in hosts], pa.string()),
                        pa.array([declared(p) for p in pages[a:b]], pa.string()),
                        pa.ListArray.from_arrays(ends, pa.array(scores.ravel())),
                    ],
                    names=[keep, "host", "domain", "suffix", "declared", "text_scores"],
                )

    return run


def _softmax(scores: Column) -> Column:
    raised = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    total = F.aggregate(raised, F.lit(0.0), lambda a, r: a + r)
    return F.transform(raised, lambda r: r / total)


def languages(pages: DataFrame, docs: DataFrame, key: str = "page_id") -> DataFrame:
    """For each row of ``pages`` (``key``, url, html): host, declared, lang, probability, text_lang."""
    names, codes, logs = learn(docs)
    rows = pages.select(key, F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    kind = rows.schema[key].dataType.simpleString()
    if not names:
        none = [F.lit(None).cast("string").alias(c) for c in ("host", "declared", "lang")]
        return rows.select(key, *none, F.lit(0.0).alias("probability"), F.lit(None).cast("string").alias("text_lang"))
    model = pages.sparkSession.sparkContext.broadcast((codes, logs))
    out = f"`{key}` {kind}, host string, domain string, suffix string, declared string, text_scores array<double>"
    seen = stored(rows.mapInArrow(_page_batches(model, key), out), "pages")
    seen = seen.withColumn("own", _softmax(F.col("text_scores")))
    sums = F.array(*(F.sum(F.col("own")[i]) for i in range(len(names))))

    def counted(group: str, prefix: str) -> DataFrame:
        """Pages and sums of their posteriors by ``group``; a page's posteriors add up to one."""
        return seen.groupBy(group).agg(F.count("*").alias(f"{prefix}_n"), sums.alias(prefix))

    whole = seen.agg(F.count("*").alias("n"), F.countDistinct("declared").alias("n_declared"),
                     F.countDistinct("suffix").alias("n_suffix"), sums.alias("all")).head()
    pages_of = [x or 0.0 for x in whole["all"]]
    listed = lambda values: F.array(*(F.lit(float(v)) for v in values))
    shares = listed((x + SMOOTH) / (whole["n"] + SMOOTH * len(names)) for x in pages_of)
    of_declared = listed(x + SMOOTH * max(1, whole["n_declared"]) for x in pages_of)
    of_suffix = listed(x + SMOOTH * max(1, whole["n_suffix"]) for x in pages_of)
    joined_ = (
        seen.join(counted("declared", "by_declared"), "declared")
        .join(counted("suffix", "by_suffix"), "suffix")
        .join(counted("domain", "by_domain"), "domain")
        .join(counted("host", "by_host"), "host")
    )

    def fused(score: Column, i: Column) -> Column:
        others = lambda c: F.get(f"by_{c}", i) - F.get("own", i)
        domain = (others("domain") + STRENGTH * F.get(shares, i)) / (F.col("by_domain_n") - 1 + STRENGTH)
        host = (others("host") + STRENGTH * domain) / (F.col("by_host_n") - 1 + STRENGTH)
        says = (F.get("by_declared", i) + SMOOTH) / F.get(of_declared, i)
        ends = (F.get("by_suffix", i) + SMOOTH) / F.get(of_suffix, i)
        return reduce(add, (F.log(F.greatest(x, F.lit(1e-12))) for x in (host, says, ends)), score)

    judged = joined_.withColumn("fused", _softmax(F.transform("text_scores", fused)))
    known = F.array(*(F.lit(n) for n in names))
    best = lambda p: F.get(known, (F.array_position(p, F.array_max(p)) - 1).cast("int"))
    return judged.select(
        key, "host", "declared", best(F.col("fused")).alias("lang"), F.array_max("fused").alias("probability"),
        best(F.col("own")).alias("text_lang"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, learnt from the labelled documents."""
    ship(spark)
    return languages(spark.read.parquet(f"{sf_dir}/pages.parquet"), documents(spark, sf_dir))
