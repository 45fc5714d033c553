"""Groups of spelling variants by asymmetric chunks (operator 11, built-in expressions).

Two words are near if one inserted, deleted or replaced code point makes one of
the other. Of a pair, the shorter word (either one, if they are equally long) is
cut into two disjoint chunks, its halves. An edit touches one of them, so the
other stands in the longer word as it is: the first half where it was, the second
moved by the difference of the lengths, which is zero or one. The longer word
therefore gives its positional grams of those lengths; a gram farther than that
from a chunk's place can join nothing and is dropped before the shuffle. Chunks
and grams meet by a 64-bit hash, and every pair is verified by edit distance, so
equal hashes of different grams do no harm.

A chunk that many words share would pair all of them. Where more than ``PAIRS``
pairs meet, the rest of the word (the hole that holds the edit) is halved again:
one half of it is also untouched, and joins the key. That goes on until the hole
is one code point, where the alphabet bounds the group. No pair is lost: an edit
inside a hole is inside one of its halves.

The form of a word is its near word of largest count, if that is ``FACTOR`` times
its own. Counts grow by that factor along a chain of forms, so chains are short;
roots come by doubling.

Every table that is joined grows with the vocabulary. Spark sizes them too low, as it
counts neither the rows that ``explode`` adds nor what repeated words take outside of
a compressed file; a join by sorting is therefore asked for wherever two of them meet,
so that none of them goes to the driver.

Defined results: null and empty texts have no words; a null ``doc_id`` counts as
an empty name; repeated rows count each for themselves; ties of the largest count
go to the smallest word in code-point order; an empty table gives no rows; other
columns are ignored; texts are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally.llm.shared import documents, stored, whole_text

#: Least code points of a word, least occurrences, and how much more frequent a form is.
LENGTH, COUNT, FACTOR = 6, 5, 5
#: One occurrence in so many loses a code point (by checksum), as the contract says.
TYPO = 199
#: A chunk in which more pairs than this would meet is cut further.
PAIRS = 1024

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def occurrences(docs: DataFrame, least: int = LENGTH, typo: int = TYPO) -> DataFrame:
    """(word) for every run of letters in ``docs`` (doc_id, text) that has ``least`` code points after the typo."""
    # Shorter runs cannot become words, as a typo only takes away.
    found = F.regexp_extract_all(whole_text(), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(name.alias("name"), F.explode(found).alias("run"))
    # Only A-Z change; lower() is the quicker way where no other capital can occur.
    accented = F.translate("run", _UPPER, _UPPER.lower())
    lower = F.when(F.col("run").rlike("[\\u00C0-\\u00DE]"), accented).otherwise(F.lower("run"))
    hashed = runs.select(lower.alias("run"), "name").select(
        "run", F.crc32(F.concat("name", F.lit(":"), "run").cast("binary")).alias("h")
    )
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % typo == 0, short).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= least)


def frequent_words(docs: DataFrame, least: int = LENGTH, count: int = COUNT, typo: int = TYPO) -> DataFrame:
    """(word, n) of the words that occur ``count`` times; counted in every task before the shuffle."""
    counted = occurrences(docs, least, typo).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= count)


def _met(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Two tables of any size joined without a broadcast of either."""
    return left.join(right.hint("merge"), on, how)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, role, grows, size, a, b) with the hash of what lies outside the hole from a to b.

    ``size`` and the hole belong to the shorter word of a pair; the longer one's
    hole is ``grows`` code points wider.
    """
    end = F.col("b") + F.when(F.col("role") == "long", F.col("grows")).otherwise(0)
    outside = F.concat(
        F.substring("word", F.lit(1), F.col("a")), F.lit("\0"), F.substring("word", end + 1, F.length("word"))
    )
    return rows.withColumn("key", F.xxhash64("grows", "size", "a", "b", outside))


def _first_holes(words: DataFrame) -> DataFrame:
    """Two holes of every word in each role it can have: beside an equally long, a longer and a shorter word."""

    def two(role: str, grows: int, size: Column) -> list[Column]:
        half = F.floor(size / 2).cast("int")
        ends = ((F.lit(0), half), (half, size))
        return [
            F.struct(
                F.lit(role).alias("role"), F.lit(grows).alias("grows"), size.alias("size"), a.alias("a"), b.alias("b")
            )
            for a, b in ends
        ]

    length = F.length("word")
    holes = F.array(*two("equal", 0, length), *two("short", 1, length), *two("long", 1, length - 1))
    return _keyed(words.select("word", "n", F.explode(holes).alias("hole")).select("word", "n", "hole.*"))


def _halved(rows: DataFrame) -> DataFrame:
    """Both halves of each hole."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b"))
    )
    cut = rows.withColumn("half", F.explode(halves))
    return _keyed(cut.select("word", "n", "role", "grows", "size", "half.a", "half.b"))


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(word, n, near, near_n): each pair of ``words`` (word, n) one edit apart, once."""
    found, holes = [], _first_holes(words)
    while True:
        here = lambda *roles: F.count_if(F.col("role").isin(*roles))
        sizes = holes.groupBy("key").agg(here("equal", "short").alias("left"), here("equal", "long").alias("right"))
        # Of one word nothing can join; words of one role have no other side.
        several = (F.col("left") > 0) & (F.col("right") > 0) & (F.col("left") + F.col("right") > 2) | (
            (F.col("left") == 1) & (F.col("right") == 1)
        )
        meets = sizes.where(several).select("key", (F.col("left") * F.col("right") > pairs).alias("full"))
        marked = stored(_met(holes, meets, "key"), "holes")
        full = F.col("full") & (F.col("b") - F.col("a") > 1)
        few = marked.where(~full)
        left = few.where("role <> 'long'").select("key", "role", "word", "n")
        right = few.where("role <> 'short'").select(
            "key", F.col("role").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")
        )
        sides = (F.col("role") == "short") & (F.col("other") == "long") | (
            (F.col("role") == "equal") & (F.col("other") == "equal") & (F.col("word") < F.col("near"))
        )
        close = F.levenshtein("word", "near", 1) == 1
        found.append(_met(left, right, "key").where(sides & close).select("word", "n", "near", "near_n"))
        rest = marked.where(full)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()
        holes = _halved(rest)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from ``forms`` (word, form) on to the last form of each chain."""
    chain = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if _met(chain, onward, "root", "left_semi").isEmpty():
            return chain
        step = _met(chain, onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        chain = stored(step, "forms")


def variants(words: DataFrame, factor: int = FACTOR, pairs: int = PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n)."""
    once = near_pairs(words, pairs)
    back = once.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    # Of the largest count the smallest word: the least pair of (minus count, word).
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = once.unionByName(back).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = _met(words, near, "word", "left")
    enough = -F.col("best.less") >= factor * F.col("n")
    out = stored(
        joined.select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).cast("long").alias("form_n"),
        ),
        "variants",
    )
    rooted = _met(out, roots(out.where("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents."""
    return variants(stored(frequent_words(documents(spark, sf_dir)), "words"))


#: Words that share what is left without one code point are compared place by place;
#: the checksum runs over bytes with the reflected polynomial 0xEDB88320.
OP11_SQL = """
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS name, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), hashed AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(name || ':' || run)),
      lambda i: ('0x' || substr(hex(encode(name || ':' || run)), 2 * i + 1, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc_table WHERE length(run) >= 6
), results AS (
  SELECT CASE WHEN h % 199 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, count(*) AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), links AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest
  WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION
  SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON w.word = c.rest
  UNION
  SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON w.word = c.rest
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -near_n, near := near)) AS b FROM links GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -b.less >= 5 * w.n THEN b.near END AS form, CASE WHEN -b.less >= 5 * w.n THEN -b.less END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), chains AS (
  SELECT word, form AS at FROM formed WHERE form IS NOT NULL
  UNION ALL
  SELECT chains.word, formed.form FROM chains JOIN formed ON formed.word = chains.at WHERE formed.form IS NOT NULL
), last AS (
  SELECT c.word, c.at FROM chains c JOIN formed f ON f.word = c.at WHERE f.form IS NULL
)
SELECT f.word, f.form, coalesce(l.at, f.word) AS root, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near,
  f.form_n::BIGINT AS form_n
FROM formed f LEFT JOIN last l ON l.word = f.word
"""
