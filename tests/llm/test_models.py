"""Operators 3 and 6 against the same models in plain Python."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from gatetally.llm import language, toxicity

from .conftest import SCHEMA

D, ORDER, SHARED = toxicity.DISCOUNT, toxicity.ORDER, toxicity.SHARED


def words_of(text):
    """Plain words in lower case with a blank on either side."""
    plain = "".join(c if c.isalnum() or c == "'" else " " for c in text.lower())
    return [f" {w} ".encode() for w in plain.split()]


def grams(words, k):
    """The strings of ``k`` bytes by how often they occur; blanks that start a word stand alone nowhere."""
    return Counter(w[i - k : i] for w in words for i in range(max(2, k), len(w) + 1))


def counts(words, first, top):
    """Counts by order: raw at the top and at word starts, else in how many contexts a string stands."""
    out = {}
    for k in range(first, top + 1):
        contexts = Counter(g[1:] for g in grams(words, k + 1)) if k < top else Counter()
        raw = grams(words, k)
        out[k] = {g: n if k == top or (g[:1] == b" " and k > 1) else contexts[g] for g, n in raw.items()}
    return out


def sums(table):
    total, kinds = defaultdict(int), defaultdict(int)
    for g, n in table.items():
        total[g[:-1]] += n
        kinds[g[:-1]] += n > 0
    return total, kinds


class KneserNey:
    def __init__(self, everything, own):
        self.orders = {}
        for tables in (counts(everything, 1, SHARED), counts(own, SHARED + 1, ORDER)):
            for k, table in tables.items():
                self.orders[k] = (table, *sums(table))

    def of(self, g):
        if not g:
            return 1 / 256
        below = self.of(g[1:])
        table, total, kinds = self.orders[len(g)]
        if not total[g[:-1]]:
            return below
        return (max(table.get(g, 0) - D, 0) + D * kinds[g[:-1]] * below) / total[g[:-1]]

    def log(self, word):
        return sum(math.log(self.of(word[max(0, i - ORDER) : i])) for i in range(2, len(word) + 1))


def test_toxicity_equals_plain_kneser_ney(spark):
    rng = random.Random(5)
    parts = ["ba", "dé", "kilo", "mu", "zorg", "x", "né'r", "7"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    usable = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5][:24]
    texts = {i: " ".join(word() for _ in range(rng.randint(3, 25))) + (" zorgzorg" if n % 2 else "!") for n, i in enumerate(usable)}
    unlabelled = {100 + i: " ".join(word() for _ in range(9)) + " q once" for i in range(6)}
    long_text = {200: "zorgba mu kilo. " * 120_000}
    everything = {**texts, **unlabelled, **long_text}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in everything.items()], SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, 1, n % 2) for n, i in enumerate(usable)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r["mean_llr"] for r in toxicity.toxicity(docs, labels).collect()}
    every = [w for t in everything.values() for w in words_of(t)]
    own = [[w for n, i in enumerate(usable) if n % 2 == c for w in words_of(texts[i])] for c in (0, 1)]
    models = [KneserNey(every, o) for o in own]
    for i, t in everything.items():
        ratio = Counter(words_of(t))
        mean = sum(n * (models[1].log(w) - models[0].log(w)) for w, n in ratio.items()) / ratio.total()
        assert found[i] == pytest.approx(mean, abs=1e-9)


def test_kneser_ney_probabilities_add_up_to_one():
    words = words_of("bad bats bat a tab abbots baa tattoo")
    model = KneserNey(words, words)
    for context in (b" ba", b"at", b"a", b"", b"att"):
        assert sum(model.of(context + bytes([c])) for c in range(256)) == pytest.approx(1, abs=1e-9)


def test_rare_strings_take_the_probability_of_their_tail():
    """Unseen strings of one context differ as their tails do."""
    words = words_of("banana bandana cabana ananas dab")
    model = KneserNey(words, [])
    assert model.of(b"xna") == model.of(b"na") != model.of(b"ab") == model.of(b"xab")


def test_more_languages_than_sixty_four(spark):
    rng = random.Random(3)
    letters = "bcdfghklmnprstvwz"
    stems = {f"l{i:02}": letters[i % 17] + "aeiouy"[i // 17] for i in range(66)}
    text = lambda k, n: " ".join(stems[k] * rng.randint(2, 3) for _ in range(n))
    docs = [(n, text(k, 30), k, "s", 1) for n, k in enumerate(list(stems) * 2)]
    pages = [(n, "https://one.example.org/", f"<p>{text(k, 20)}</p>") for n, k in enumerate(stems)]
    pages += [(100, "https://one.example.org/", "<b>" + text("l65", 200_000) + "</b>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r["page_id"]: r["lang"] for r in language.languages(df, spark.createDataFrame(docs, SCHEMA)).collect()}
    assert out == {**{n: k for n, k in enumerate(stems)}, 100: "l65"}


def test_language_sample_is_the_least_hashes(spark):
    """Only the sample's trigrams are known, whatever part of a large language the rows come from."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('w', translate(conv(id, 10, 5), '01234', 'abcde')) as text", "'aa' as lang")
    names, codes, logs = language.learn(docs, sample=40)
    chosen = docs.selectExpr("*", "xxhash64(doc_id) as h").orderBy("h", "doc_id").limit(40).collect()
    padded = [f" {r['text']} ".encode() for r in chosen]
    expected = {int.from_bytes(t[i : i + 3]) for t in padded for i in range(len(t) - 2) if t[i : i + 3].count(b" ") < 2}
    assert names == ["aa"] and logs.shape == (1, len(codes) + 1)
    assert set(codes.tolist()) == expected


def test_trigrams_stay_in_their_text():
    texts = ["abc", "", "de f", "ghi"]
    code, text = language.trigrams(texts)
    apart = [(c, n) for n, t in enumerate(texts) for c in language.trigrams([t])[0].tolist()]
    assert list(zip(code.tolist(), text.tolist(), strict=True)) == apart


def fused_by_hand(names, texts, pages):
    """Operator 6 on parsed pages (host, domain, suffix, declared), given the logarithms of the texts."""
    soft = lambda s: [math.exp(x - max(s)) / sum(math.exp(y - max(s)) for y in s) for x in s]
    own = [soft(t) for t in texts]
    every = range(len(names))
    whole = [sum(p[i] for p in own) for i in every]
    out = []
    for t, p, page in zip(texts, own, pages, strict=True):
        sums_by = [[sum(q[i] for q, other in zip(own, pages, strict=True) if other[c] == page[c]) for i in every] for c in range(4)]
        total = []
        for i in every:
            share = (whole[i] + language.SMOOTH) / (len(pages) + language.SMOOTH * len(names))
            domain = (sums_by[1][i] - p[i] + language.STRENGTH * share) / (sum(sums_by[1]) - 1 + language.STRENGTH)
            host = (sums_by[0][i] - p[i] + language.STRENGTH * domain) / (sum(sums_by[0]) - 1 + language.STRENGTH)
            kinds = [len({other[c] for other in pages}) for c in (3, 2)]
            says = (sums_by[3][i] + language.SMOOTH) / (whole[i] + language.SMOOTH * kinds[0])
            ends = (sums_by[2][i] + language.SMOOTH) / (whole[i] + language.SMOOTH * kinds[1])
            total.append(t[i] + sum(math.log(max(x, 1e-12)) for x in (host, says, ends)))
        out.append(soft(total))
    return out


def test_languages_equal_plain_fusion(spark):
    rng = random.Random(8)
    kinds = {"aa": "lor mip tak sun", "bb": "lor quu ebb sun", "cc": "zan ebb tak oro"}
    text = lambda k, n: " ".join(rng.choices(kinds[k].split(), k=n))
    docs = [(n, text(k, 12), k, "s", 1) for n, k in enumerate(list(kinds) * 5)]
    rows = []
    for n in range(24):
        k = list(kinds)[n % 3]
        host = f"h{n % 4}.site{n % 2}.{k if n % 5 else 'org'}"
        rows.append((n, f"http://{host}/x", f"<html lang={k}>{text(k, rng.randint(0, 4))}" if n % 7 else text(k, 2)))
    names, codes, logs = language.learn(spark.createDataFrame(docs, SCHEMA))
    texts, pages = [], []
    for _, url, html in rows:
        code, _ = language.trigrams([language.visible(html)])
        at = [codes.tolist().index(c) if c in codes else len(codes) for c in code.tolist()]
        weight = min(len(at), language.WEIGHT) / max(len(at), 1)
        texts.append([sum(float(row[i]) for i in at) * weight for row in logs])
        host = language.host_of(url)
        pages.append((host, ".".join(host.split(".")[-3:]), host.rpartition(".")[2], language.declared(html)))
    by_hand = fused_by_hand(names, texts, pages)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in language.languages(df, spark.createDataFrame(docs, SCHEMA)).collect():
        expected = by_hand[r["page_id"]]
        assert r["probability"] == pytest.approx(max(expected), abs=1e-9)
        assert r["lang"] == names[expected.index(max(expected))]
