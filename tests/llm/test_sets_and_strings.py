"""Operators 2, 4, 5, 7 and 8 against plain Python."""

import hashlib
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gatetally.llm import count_rtree, decontaminate, prefix_free, quality, sharding

from .conftest import SCHEMA, rows_of

LAST = 1 << 63


def brute_cut(rows, size=50):
    strings = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - size + 1):
            s = raw[i : i + size]
            strings[s] = min(strings.get(s, LAST), LAST - 1 if doc is None else doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - size + 1):
            if strings[raw[i : i + size]] < (LAST - 1 if doc is None else doc):
                gone[i : i + size] = [True] * size
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_prefix_free_removal(corpus, hot):
    found = prefix_free.without_repeats(corpus.select("doc_id", "text"), hot=hot).select("row.doc_id", "*")
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_cut(rows)


@pytest.mark.parametrize(("hot", "rounds"), [(20_000, 1), (2, 3)])
def test_prefix_free_removal_in_any_number_of_rounds(corpus, hot, rounds):
    docs = corpus.select("doc_id", "text")
    found = prefix_free.without_repeats(docs, hot=hot, rounds=rounds).select("row.doc_id", "*")
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_cut(rows)


def test_rounds_share_the_phrases(corpus):
    texts = [r["text"] or "" for r in corpus.collect()]
    batch = pa.RecordBatch.from_pydict({"doc": range(len(texts)), "crc": [0] * len(texts), "text": texts})

    def kept(*which):
        tables = [b.to_pydict() for b in prefix_free._parse_batches(50, 16, *which)([batch])]
        return Counter((a, e, d) for t in tables for a, e, d, n in zip(t["a"], t["e"], t["doc"], t["size"]) if n > 0)

    parts = [kept(k, 3) for k in range(3)]
    assert sum(parts, Counter()) == kept() and all(sum(p.values()) < 0.5 * sum(kept().values()) for p in parts)


def test_settled_rounds_leave_no_shuffle_files(spark, corpus):
    docs = corpus.select("doc_id", "text")
    docs.count()

    def files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f and f.endswith(".data")}

    before = files()
    cut = prefix_free.without_repeats(docs)
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left
    assert cut.count() == docs.count()


@pytest.mark.parametrize("cut", [1, 2, 3, 50])
def test_crowded_triggers_are_told_once_wherever_batches_end(cut):
    rows = [(1, e, d, 0, 60) for e in (3, 4, 5) for d in (7, 8)]
    rows += [(2, 3, 1, 0, 60), (3, 3, 1, 0, 60), (3, 9, 1, 0, 60), (4, 1, 5, 0, -9), (5, 1, 1, 0, 50), (5, 2, 1, 0, 50), (5, 3, 1, 0, 50)]

    def batch(some):
        return pa.RecordBatch.from_pydict(dict(zip(prefix_free._PHRASE_SCHEMA.names, zip(*some), strict=True)), prefix_free._PHRASE_SCHEMA)

    out = [r for b in prefix_free._dictionary(2)(batch(rows[i : i + cut]) for i in range(0, len(rows), cut)) for r in b.to_pylist()]
    assert sorted(r["a"] for r in out if r["size"] == 0) == [1, 5]
    assert sorted((r["a"], r["e"]) for r in out if r["size"] > 0) == [(1, 3), (1, 4), (1, 5), (3, 3), (3, 9), (5, 1), (5, 2), (5, 3)]
    assert sorted((r["a"], r["doc"], r["size"]) for r in out if r["size"] < 0) == [(1, 8, -60)] * 3 + [(4, 5, -9)]


def test_cut_texts_keep_columns(corpus, empty):
    clash = corpus.withColumn("doc", F.lit(1)).withColumn("crc", F.lit("x")).withColumn("kept_text", F.lit(2))
    out = prefix_free.cut_texts(clash)
    assert out.columns == clash.columns and out.count() == clash.count()
    assert out.where("n_chars <> length(text)").count() == 0
    assert prefix_free.cut_texts(empty).count() == 0


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                label[find(i)] = find(j)
    roots = [find(i) if s else None for i, s in enumerate(sets)]
    least = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    named = [(d, len(s), least.get(r) if s else d) for (d, _), s, r in zip(rows, sets, roots, strict=True)]
    return named, roots


@pytest.mark.parametrize("block", [4000, 2])
def test_components_of_similar_sets(corpus, block):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    found = count_rtree.shingle_components(corpus, block=block)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(brute_components(rows)[0], key=repr)


def star(n):
    """A text of nine words and ``n`` variants with one more word, which link with it but not with each other."""
    stem = "a star has one stem and a thousand rays"
    return [(i, stem + (f" ray{i}" if i else "")) for i in range(n + 1)]


def test_variants_of_one_text_link_through_it(spark):
    rows = star(2000)
    found = count_rtree.shingle_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = sorted(brute_components(rows)[0], key=repr)
    assert {c for *_, c in want} == {0}
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == want


def test_partners_in_other_blocks_are_found(spark):
    rows = star(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = count_rtree.shingle_components(docs, block=3)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == sorted(brute_components(rows)[0], key=repr)


def test_one_of_each_component_stays(corpus, empty):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    _, roots = brute_components(rows)
    clash = corpus.withColumn("label", F.lit(1)).withColumn("_node", F.lit(2))
    out = count_rtree.one_of_each(clash)
    assert out.columns == clash.columns and out.count() == len(set(roots) - {None}) + roots.count(None)
    assert count_rtree.one_of_each(empty).count() == 0
    assert count_rtree.shingle_components(empty).count() == 0


def test_the_stage_takes_five_words_and_eighty_percent(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline", exc_type=ImportError)
    words = [f"w{i}" for i in range(99)]
    changed = [w if i not in (30, 60) else "new" for i, w in enumerate(words)]
    far = [w if i not in (20, 40, 60) else "new" for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(w + "x" for w in words)), (4, " ".join(far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(corpus_pipeline.ngram_jaccard(spark, docs.where("doc_id < 4"), ""), "doc_id") == [(1,), (3,)]
    assert corpus_pipeline.ngram_jaccard(spark, docs.where("doc_id in (1, 4)"), "").count() == 2
    assert count_rtree.one_of_each(docs.where("doc_id < 3")).count() == 2


def test_tree_finds_all_pairs_within_the_bound():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 6, (400, 8)).astype(np.int32)
    points[200:] = points[:200] + (rng.random((200, 8)) < 0.1)
    sizes = points.sum(1)
    want = set()
    for i in range(400):
        for j in range(i):
            if 100 * min(sizes[i], sizes[j]) >= 85 * max(sizes[i], sizes[j]):
                if np.minimum(points[i], points[j]).sum() >= -(-85 * (sizes[i] + sizes[j]) // 185):
                    want.add((j, i))
    found = set()
    for i, j, _ in count_rtree.RTree(sizes, points).pairs(85):
        a, b = np.minimum(i, j), np.maximum(i, j)
        keep = count_rtree.alike(sizes[a], sizes[b], 85)
        found |= set(zip(a[keep].tolist(), b[keep].tolist(), strict=True))
    assert found >= want and len(found) <= len(want) + 5


def brute_quality(text):
    words = (text or "").encode().split()
    out = []
    for m in (3, quality.MIN_REPEAT):
        count = Counter(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
        out.append({i + k for i in range(len(words) - m + 1) if count[tuple(words[i : i + m])] > 1 for k in range(m)})
    longest = 0
    if out[1]:
        longest = quality.MIN_REPEAT
        while len({tuple(words[i : i + longest + 1]) for i in range(len(words) - longest)}) < len(words) - longest:
            longest += 1
    lines = [x for x in (text or "").split("\n") if x.strip(quality.SPACES)]
    chars = sum(len(w.decode()) for w in words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(out[0]) > 50 * len(words)
    kept = not failed and 100 * len(out[1]) <= quality.MAX_COVERED * len(words) and longest <= quality.MAX_REPEAT
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(out[0]), len(out[1]), longest, failed, kept


def test_quality_rules(corpus, empty):
    found = quality.quality_rules(corpus)
    rows = corpus.collect()
    want = [(r["doc_id"], *brute_quality(r["text"])) for r in rows]
    names = [*quality._NAMES, "base_failed", "kept"]
    assert rows_of(found, "doc_id", *names) == sorted(want, key=repr)
    clash = corpus.withColumn("n_words", F.lit(1)).withColumn("kept", F.lit("x"))
    assert quality.kept_rows(clash).count() == sum(w[-1] for w in want)
    assert quality.kept_rows(empty).count() == quality.quality_rules(empty).count() == 0


def test_a_text_is_rejected_by_long_repeats(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words + words[100:320])), (3, " ".join(words + words[:9]))]
    found = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(found, "doc_id", "longest_repeat", "kept") == [(1, 0, True), (2, 220, False), (3, 9, True)]


def test_benchmark_passages(spark, corpus, empty):
    texts = {r["doc_id"]: r["text"] for r in corpus.collect() if r["text"]}
    words = texts[10].split()
    near = words[5:45]
    near[20] = "other"
    items = [(1, " ".join(words[5:45])), (2, " ".join(near)), (3, None), (4, ""), (5, "one"), (6, "zzz yyy")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(corpus.withColumn("item_id", F.lit(9)), bench)
    pairs = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()}
    assert pairs[10, 1] == 1.0 and (10, 2) not in pairs
    assert {d for d, i in pairs if i == 5} == {d for d, t in texts.items() if re.search(r"(?<!\w)one(?!\w)", t.lower())}
    assert not {i for _, i in pairs} & {3, 4, 6}
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(corpus, bench.limit(0)).count() == 0


def brute_passages(text, item, words=5):
    """The greatest similarity of any window of the item's size, cut off at either end of the text."""
    doc, own = (re.findall(r"[^\W_]+", t.lower()) for t in (text, item))
    k, best = min(words, len(own)), 0.0
    there = Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
    for s in range(1 - len(own), len(doc)):
        view = doc[max(0, s) : s + len(own)]
        here = Counter(tuple(view[i : i + k]) for i in range(max(1, len(view) - k + 1)))
        shared = sum((here & there).values())
        best = max(best, shared / (sum(here.values()) + sum(there.values()) - shared))
    return best


def test_reordered_passages_of_a_benchmark(spark):
    item = [f"w{i}" for i in range(50)]
    swapped = item[25:] + item[:25]
    thirds = item[34:] + item[:17] + item[17:34]
    other = [f"o{i}" for i in range(200)]
    texts = [
        other[:60] + swapped + other[60:120],
        swapped,
        swapped[3:] + other[:80],
        other[:80] + swapped[:-4],
        other[:70] + thirds + other[70:90] + item[:30] + other[90:],
        other[:70] + item[:24] + ["new", "words"] + item[24:] + other[70:],
        other[:70] + item[:30] + other[70:],
        item[:46],
        item + item,
        other[:20] + ["one", "two"] + other[20:40],
        ["one"],
    ]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    items = [(1, " ".join(item)), (2, "one two"), (3, " ".join(item[:10] * 3)), (4, "one")]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want = {(d, i): brute_passages(t, x) for d, t in docs for i, x in items}
    want = {pair: value for pair, value in want.items() if value >= 0.8}
    assert (0, 1) in want and (1, 1) in want and (7, 1) in want and (6, 1) not in want
    got = found.collect()
    assert len(got) == len(want)
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in got} == pytest.approx(want)
    assert {r["start_word"] for r in got if (r["doc_id"], r["item_id"]) == (0, 1)} == {60}


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * sharding.MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards(spark, corpus, empty):
    rows = corpus.select("doc_id").unionByName(spark.range(-50, 500).withColumnRenamed("id", "doc_id"))
    out = sharding.shard_rows(rows.withColumn("state", F.lit(1)), 16, cuts=8).collect()
    for r in out:
        key = (r["doc_id"] or 0) % (1 << 64)
        assert (r["shard"], r["grown_shard"]) == (jump(key, 16), jump(key, 17))
        assert r["grown_shard"] in (r["shard"], 16)
    slots = {}
    for r in sorted(out, key=lambda r: (r["shard"], r["slot"])):
        assert r["slot"] == slots.setdefault(r["shard"], 0)
        slots[r["shard"]] += 1
    assert len(out) == rows.count()
    assert sharding.shard_rows(empty.select("doc_id"), 16).count() == 0


def test_schema_is_that_of_documents(corpus):
    assert corpus.schema.simpleString() == "struct<" + SCHEMA.replace(", ", ",").replace(" long", ":bigint").replace(
        " string", ":string"
    ) + ">"
