"""Operators 11 to 13 against plain Python, the library and SQL."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from gatetally.llm import byte_bpe, parens, prefix_trie, registry, spelling
from workload.compare import duck
from workload.compare import rows_of as plain

from .conftest import SCHEMA, rows_of

RANKS = public_tokenizers.path(byte_bpe.RANKS)
TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", ["op11_spelling", "op13_prefix_trie"])
def test_query_equals_sql(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    answer = duck(sf_dir).sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(answer.columns)
    assert plain(df.columns, df.collect()) == plain(answer.columns, answer.fetchall()) != []


# Spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(words):
    """(word, form, root, n, n_near, form_n) by comparing all words."""
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    rows = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(rows, key=repr)


def variants_of(spark, words, pairs=spelling.PAIRS):
    df = spark.createDataFrame(sorted(words.items()), "word string, n long")
    return rows_of(spelling.variants(df, pairs=pairs), "word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("pairs", [0, 1024])
def test_variants_equal_brute_force_at_any_width_of_a_chunk(spark, pairs):
    rng = random.Random(pairs)
    words = {}
    for _ in range(30):
        base = "".join(rng.choice("abé") for _ in range(rng.randint(6, 9)))
        words[base] = rng.randint(100, 5000)
        for _ in range(12):
            at, letter = rng.randrange(len(base)), rng.choice("abéÿ")
            edited = rng.choice([base[:at] + base[at + 1 :], base[:at] + letter + base[at:], base[:at] + letter + base[at + 1 :]])
            if len(edited) >= 6:
                words.setdefault(edited, rng.randint(5, 400))
    words |= {"aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 30, "z" * 3000: 7, "z" * 3001: 70}
    assert variants_of(spark, words, pairs) == spelled(words)


def test_a_chunk_that_many_words_share_keeps_every_pair(spark):
    rng = random.Random(1)
    words = {"sharedstem" + "".join(rng.choice("abcdefgh") for _ in range(10)): rng.randint(5, 99) for _ in range(700)}
    words |= {w[:-1] + "z": 600 for w in list(words)[::5]}
    words |= {w[:12] + w[13:]: 9 for w in list(words)[::7]}
    assert variants_of(spark, words, 50) == spelled(words)


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    plans = []
    keep = spelling.stored

    def planned(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return df

    monkeypatch.setattr(spelling, "stored", lambda df, label: keep(planned(df), label))
    words = spark.createDataFrame([("abcdef", 50), ("abcdeg", 5), ("abcdefg", 400), ("zyxwvu", 9)], "word string, n long")
    assert planned(spelling.variants(words)).count() == 4
    assert sum(p.count("SortMergeJoin") for p in plans) >= 5
    assert not [p for p in plans if "Broadcast" in p or "ShuffledHash" in p]


def test_words_of_texts(spark, corpus):
    def expected(rows):
        n = Counter()
        for r in rows:
            for run in regex.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
                run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 6:
                    n[run] += 1
        return sorted((w, c) for w, c in n.items() if c >= 5)

    texts = ["ÀÉ×Strasse÷ÿabcdef " * 9, "UPPERcase uppercase İstanbul " * 5, "µabcdef naïveté NAÏVETÉ " * 6]
    odd = spark.createDataFrame([(i, t, "fr", "s", 1) for i, t in enumerate(texts)] * 3, SCHEMA)
    for docs in (corpus, odd):
        assert rows_of(spelling.frequent_words(docs), "word", "n") == expected(docs.collect()) != []


def test_no_words(spark, empty):
    assert spelling.variants(spelling.frequent_words(empty)).count() == 0


# Byte-level BPE


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("run_chars", [1, 500, byte_bpe.RUN_CHARS])
def test_ids_equal_the_library_and_decode(corpus, library, run_chars):
    codes = byte_bpe.encoded(corpus, RANKS, run_chars=run_chars)
    want = [(r["doc_id"], library.encode_ordinary(r["text"] or "")) for r in corpus.collect()]
    found = [(r["doc_id"], list(r["ids"])) for r in codes.collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    back = [(r["doc_id"], bytes(r["bytes"]).decode()) for r in byte_bpe.decoded(codes, RANKS).collect()]
    assert sorted(back, key=repr) == sorted(((r["doc_id"], r["text"] or "") for r in corpus.collect()), key=repr)


ODD_TEXTS = [
    "", " ", "  ", " a", "a ", "a  b", "a   ", "\n", " \n ", "a \nb", "a\n b", "a\x1c\x1cb \x1c c", "a\x85 \x85b　c",
    "it's we'LL 'tis I'd'd", "x1y22 333 ²³ ½", "日本語 テキスト 🙂🙂", "<|endoftext|> <s>", "áé é", "\0\0 \0",
    "tab\t\ttab \t end", "don't  stop\r\n\r\n", "_under_score_ --- ...", "a" * 5000, " nb sp ", "ﬀ Ǆ ß İ",
]


def test_odd_texts(spark, library):
    rng = random.Random(5)
    alphabet = "ab'Ts1½  \n\t  \x1c\x85é日.-"
    texts = ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: list(r["ids"]) for r in byte_bpe.encoded(docs, RANKS).collect()}
    assert found == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_a_text_of_megabytes(spark, library):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=400_000)), "ab" * 150_000, " " * 100_000 + "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: list(r["ids"]) for r in byte_bpe.encoded(docs, RANKS).collect()}
    assert found[0] == library.encode_ordinary(texts[0])
    assert library.decode(found[1]) == texts[1] and library.decode(found[2]) == texts[2]


def test_bpe_query_digests(spark, sf_dir, library):
    found = {r["doc_id"]: r for r in registry.QUERIES["op12_byte_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        row = found[r["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_runs_that_change_between_readings_are_refused():
    head = {"run": 1, "seal": 5, "bucket": -1, "numbers": byte_bpe.squeezed(np.array([0, 0])), "ids": None}
    rows = [head | {"doc_ids": [1], "counts": [2]}, {"run": 1, "seal": 5, "bucket": 0} | {"doc_ids": None, "counts": None}]
    rows[1] |= {"numbers": byte_bpe.squeezed(np.array([0])), "ids": byte_bpe.packed([b"\1\0"])}
    batch = byte_bpe.pa.RecordBatch.from_pylist(rows)
    assert [b.to_pylist() for b in byte_bpe.assemble(RANKS)(iter([batch]))] == [[{"doc_id": 1, "ids": [1, 1]}]]
    other = byte_bpe.pa.RecordBatch.from_pylist([rows[0], rows[1] | {"seal": 6}])
    for changed in (other, batch.slice(0, 1)):
        with pytest.raises(RuntimeError, match="changed"):
            list(byte_bpe.assemble(RANKS)(iter([changed])))


def test_no_texts(empty):
    codes = byte_bpe.encoded(empty, RANKS)
    assert codes.count() == 0 and byte_bpe.decoded(codes, RANKS).count() == 0


# Tries


def test_parens_find_their_closes():
    rng = random.Random(2)
    for n, lean in ((1, 0.5), (40, 0.5), (3000, 0.5), (3000, 0.9), (3000, 0.1), (700, 1.0)):
        bits, depth, left = [1], 1, n - 1
        while left or depth:
            up = left and (depth == 1 or rng.random() < lean)
            if not up and depth == 1 and left:
                up = True
            bits.append(1 if up else 0)
            depth, left = (depth + 1, left - 1) if up else (depth - 1, left)
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        tree = parens.Parens(np.array(bits, np.uint8))
        opens = np.array(sorted(close))
        assert tree.close_of(opens).tolist() == [close[p] for p in opens.tolist()]
        places = np.arange(len(bits) + 1)
        assert tree.rank(places).tolist() == [0, *np.cumsum(bits).tolist()]


def trie_of(paths):
    """Rows of the contract for ``paths`` (conv_id to a list of (role, text)), node by node."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, cs in members.items():
        own = (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            (min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children[node], leaves[node])
            + (saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
            for node, cs in members.items()
        ),
        key=repr,
    )


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def in_python(turns, splice=True):
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: tuple(t[3:] for t in sorted(ts)) for c, ts in by.items()}
    if not splice:
        return own
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, ())[: heads[c]] + own[c][heads[c] :] for c in own}


@pytest.mark.parametrize("shard_turns", [3, prefix_trie.SHARD_TURNS])
def test_tries_equal_plain_python(spark, shard_turns):
    rng = random.Random(shard_turns)
    turns = []
    for c in [*range(90), 2**62, 1003, 1004]:
        first = rng.choice([None, "hello", "hello", "é"])
        for k in range(rng.choice([0, 1, 2, 3, 5, 12])):
            text = first if k == 0 else rng.choice(["x", "yy", "", None, "zzz"])
            turns.append((c, rng.choice([k, k, None]), rng.choice(["user", None, "assistant"]), text))
    turns += [t for t in turns if t[0] == 15] + [(None, 1, "user", "nobody's")]
    turns += [(200 + i, k, "user", "same") for i in range(40) for k in range(3)]
    turns += [(400, k, "user", f"long {k % 3}") for k in range(200)] + [(401, 0, None, "w" * 3_000_000)]
    df = spark.createDataFrame(turns, TURNS).repartition(5)
    convs = prefix_trie.conversations(df)
    for found, splice in ((convs, False), (prefix_trie.rebuilt(convs), True)):
        paths = in_python(turns, splice)
        assert rows_of(prefix_trie.nodes(found, shard_turns), *COLUMNS) == trie_of(paths)


def test_copies_over_many_tasks_are_one_node(spark):
    turns = [(c, k, "user", "same" if c < 3000 or k < 2 else f"t{c}") for c in range(3300) for k in range(3)]
    df = spark.createDataFrame(turns, TURNS)
    found = prefix_trie.nodes(prefix_trie.conversations(df), 1000)
    assert rows_of(found, *COLUMNS) == trie_of(in_python(turns, False))


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.conversations(none))).count() == 0
    unnamed = spark.createDataFrame([(None, 0, "user", "text")], TURNS)
    assert prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.conversations(unnamed))).count() == 0
