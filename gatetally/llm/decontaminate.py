"""Passages of a benchmark in documents by SimHash windows (operator 7, built-in expressions only).

1. *Windows.* A window has as many words as an item and may start at any word. A
   similar one holds, at any of its places, shingles of ``WORDS`` words of an item:
   at least the least similarity times the item's number. All windows with so many
   shingles of items of their size are taken, whatever the order of the shingles.
2. *Fingerprints.* Each bit of a SimHash is the sign of the sum over the shingles
   of a window, plus or minus one by a bit of their hash. Items get theirs alike.
3. *Index.* Fingerprints are cut into ``RADIUS + 1`` blocks. Two that differ in at
   most ``RADIUS`` bits agree in some block, so an equality join by (window size,
   block, value) finds all pairs within the radius; farther ones are dropped. At
   the least similarity the expected distance is 9.7 bits of 64, deviation 2.9.
4. *Verification.* The similarity is that of the shingles weighted by how often
   they occur: the sum of smaller counts over the sum of larger ones.

The scan of the documents is narrow: shingle hashes meet those of the items in a
join whose item side is broadcast while it has at most ``BROADCAST`` rows, and
shuffled beyond. Only documents with windows are read again.

Defined results: one row for each document row and item that pass, for the most
similar window; of equal ones, one that puts some shingle at its place in an item
comes before others, then the first. Words are runs of letters and digits in
lower case. Null or empty texts and items without words never match; an item of
fewer than ``WORDS`` words is one shingle; a window is cut off at either end of
its text; repeated items match each for itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally.llm.shared import documents, stored, whole_text

#: Words of a shingle, least similarity, bits by which fingerprints may differ.
WORDS, SIMILARITY, RADIUS = 5, 0.8, 22
#: Most rows of the item side that are broadcast (about 40 bytes each).
BROADCAST = 500_000
#: Stands for a null doc_id.
_LAST = (1 << 63) - 1
_SPLIT = r"[^\p{L}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def shingles_of(words: Column, k: Column | int, of: Callable[[Column], Column] | None = None) -> Column:
    """The shingles of ``k`` words as texts (or as ``of`` makes them), in order; one of all words if there are fewer."""
    k = F.lit(k) if isinstance(k, int) else k
    of = of or (lambda some: F.concat_ws(" ", some))

    def every(w: Column) -> Column:
        return F.transform(
            F.when(F.size(w) > 0, F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0)))),
            lambda i: of(F.slice(w, i + 1, F.least(k, F.size(w)))),
        )

    return let(words, every)


def simhash(shingles: Column) -> Column:
    """64 bits: the sign of each bit's sum over the shingles' hashes."""

    def bit(hashes: Column, b: int) -> Column:
        ones = F.aggregate(
            hashes, F.lit(0).cast("long"), lambda n, h: n + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1).cast("long"))
        )
        return F.when(2 * ones > F.size(hashes), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    return let(hashes, lambda hs: reduce(lambda x, y: x.bitwiseOR(y), (bit(hs, b) for b in range(64))))


def blocks_of(fingerprint: Column, radius: int) -> Column:
    """The ``radius + 1`` blocks of a fingerprint as an array of numbers."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return F.array(
        *(
            F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        )
    )


def sized(side: DataFrame, rows: int) -> DataFrame:
    """``side``, to be broadcast if ``rows``, its measured number of rows, is within the bound."""
    return F.broadcast(side) if rows <= BROADCAST else side


def window_starts(places: Column, spread: Column, least: Column) -> Column:
    """All starts of windows that hold at least ``least`` of the sorted ``places``, none more than ``spread`` words in."""
    first = F.transform(
        F.slice(places, 1, F.greatest(F.size(places) - least + 1, F.lit(0))),
        lambda p, i: F.struct((F.get(places, i + least - 1) - spread).alias("low"), p.alias("high")),
    )
    fits = F.filter(first, lambda r: r["low"] <= r["high"])
    return F.array_distinct(F.flatten(F.transform(fits, lambda r: F.sequence(r["low"], r["high"]))))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, words: int = WORDS
) -> DataFrame:
    """doc_id, crc (of the text), item_id, start_word, n_words and similarity of passages of ``benchmark`` in ``docs``."""
    text = whole_text()
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
        F.crc32(text.cast("binary")).alias("crc"),
        text.alias("text"),
    )
    items = (
        benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", words_of(F.col("text")).alias("words"))
        .withColumn("length", F.size("words"))
        .where("length > 0")
        .withColumn("k", F.least(F.lit(words), "length"))
        .withColumn("shingles", shingles_of(F.col("words"), F.col("k")))
        .withColumn("seeds", shingles_of(F.col("words"), F.col("k"), F.xxhash64))
    )
    items = stored(items.withColumn("print", simhash(F.col("shingles"))).drop("words"), "items")
    seeds = items.select("k", "length", F.posexplode("seeds").alias("at", "h")).distinct()
    n_seeds, kinds = seeds.count(), [r["k"] for r in items.select("k").distinct().collect()]
    own = words_of(F.col("text"))
    looked = [
        rows.select(
            "doc", "crc", F.lit(k).alias("k"),
            F.posexplode(shingles_of(own, k, F.xxhash64)).alias("place", "h"),
        )
        for k in sorted(kinds)
    ]
    if not looked:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, crc long, item_id long, start_word int, n_words int, similarity double"
        )
    found = reduce(DataFrame.unionByName, looked).join(sized(seeds, n_seeds), ["k", "h"])
    hits = found.groupBy("doc", "crc", "length", "k").agg(
        F.sort_array(F.collect_set("place")).alias("places"),
        F.collect_set(F.col("place") - F.col("at")).alias("aligned"),
    )
    spread = F.col("length") - F.col("k")
    least = F.greatest(F.lit(1), F.ceil(F.lit(similarity) * (spread + 1) - 1e-9).cast("int"))
    hits = hits.withColumn("starts", window_starts(F.col("places"), spread, least)).where("size(starts) > 0")
    wanted = hits.groupBy("doc", "crc").agg(F.collect_list(F.struct("length", "starts", "aligned")).alias("wanted"))
    texts = rows.join(wanted, ["doc", "crc"]).select("doc", "crc", own.alias("words"), F.explode("wanted").alias("w"))
    # In a text shorter than the item, all windows that hold the whole text are one.
    whole_from = F.size("words") - F.col("w.length")
    same = lambda s: F.when((s < 0) & (s >= whole_from), F.lit(0)).otherwise(s)
    starts, aligned = (F.array_distinct(F.transform(f"w.{c}", same)) for c in ("starts", "aligned"))
    marks = lambda some, seeded: F.transform(
        some, lambda s: F.struct(s.alias("at"), F.lit(seeded).alias("seeded"))
    )
    both = F.concat(marks(F.array_intersect(starts, aligned), True), marks(F.array_except(starts, aligned), False))
    windows = texts.select("doc", "crc", "words", F.col("w.length").alias("length"), F.explode(both).alias("w"))
    start = F.greatest(F.lit(0), F.col("w.at"))
    windows = windows.select(
        "doc", "crc", start.alias("start"), "length", "w.seeded",
        F.slice("words", start + 1, F.least(F.col("w.at") + F.col("length"), F.size("words")) - start).alias("words"),
    )
    windows = windows.withColumn("n_words", F.size("words")).where("n_words > 0")
    windows = windows.withColumn("shingles", shingles_of(F.col("words"), F.least(F.lit(words), "length"))).drop("words")
    marked = stored(windows.distinct().withColumn("print", simhash(F.col("shingles"))), "windows")
    block = lambda side, name: side.select(
        *name, "length", "print", F.posexplode(blocks_of(F.col("print"), radius)).alias("block", "value")
    )
    n_items = items.count()
    known = block(items, ["item"]).withColumnRenamed("print", "item_print")
    pairs = block(marked, ["doc", "crc", "start"]).join(
        sized(known, n_items * (radius + 1)), ["length", "block", "value"]
    )
    near = pairs.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    near = near.select("doc", "crc", "start", "length", "item").distinct()
    counted = (
        marked.join(near, ["doc", "crc", "start", "length"])
        .select(
            "doc", "crc", "start", "seeded", "n_words", "item",
            F.size("shingles").alias("of"), F.explode("shingles").alias("shingle"),
        )
        .groupBy("doc", "crc", "start", "seeded", "n_words", "item", "of", "shingle")
        .agg(F.count("*").alias("here"))
    )
    there = items.select("item", "item_id", F.size("shingles").alias("whole"), F.explode("shingles").alias("shingle"))
    there = there.groupBy("item", "item_id", "whole", "shingle").agg(F.count("*").alias("there"))
    shared = F.sum(F.least("here", "there"))
    scored = (
        counted.join(sized(there, n_seeds), ["item", "shingle"])
        .groupBy("doc", "crc", "start", "seeded", "n_words", "item", "item_id", "of", "whole")
        .agg(shared.alias("shared"))
        .withColumn("similarity", F.col("shared") / (F.col("of") + F.col("whole") - F.col("shared")))
        .where(F.col("similarity") >= similarity)
    )
    best = F.max(F.struct("similarity", "seeded", (-F.col("start")).alias("before"), "n_words")).alias("best")
    return (
        scored.groupBy("doc", "crc", "item", "item_id")
        .agg(best)
        .select(
            F.expr(f"nullif(doc, {_LAST})").alias("doc_id"), "crc", "item_id",
            (-F.col("best.before")).cast("int").alias("start_word"), "best.n_words", "best.similarity",
        )
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark."""
    found = contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("crc")


OP7_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL
), items AS (
  SELECT *, len(w) AS n, least(5, len(w)) AS k FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
    FROM benchmark WHERE text IS NOT NULL)
  WHERE len(w) > 0
), item_places AS (
  SELECT item_id, n, k, i AS pos, array_to_string(w[i + 1 : i + k], ' ') AS s FROM items, unnest(range(n - k + 1)) r(i)
), seeds AS (
  SELECT DISTINCT n, k, pos, s FROM item_places
), doc_places AS (
  SELECT doc_id, k, i AS place, array_to_string(w[i + 1 : i + k], ' ') AS s
  FROM docs, (SELECT DISTINCT k FROM items), unnest(range(greatest(0, len(w) - k + 1))) r(i)
), windows AS (
  SELECT DISTINCT doc_id, n, greatest(0, place - pos) AS a, place - pos + n AS b FROM doc_places JOIN seeds USING (k, s)
), cut AS (
  SELECT DISTINCT doc_id, n, a, w[a + 1 : least(b, len(w))] AS v FROM windows JOIN docs USING (doc_id)
), window_shingles AS (
  SELECT doc_id, n, a, len(v) AS n_words, greatest(1, len(v) - least(5, n) + 1) AS of,
    unnest(list_transform(range(greatest(1, len(v) - least(5, n) + 1)),
      lambda i: array_to_string(v[i + 1 : i + least(5, n)], ' '))) AS s
  FROM cut
), here AS (
  SELECT doc_id, n, a, n_words, of, s, count(*) AS c FROM window_shingles GROUP BY ALL
), there AS (
  SELECT item_id, n, n - k + 1 AS whole, s, count(*) AS c FROM item_places GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, a, n_words, of, whole, sum(least(here.c, there.c)) AS m
  FROM here JOIN there USING (n, s) GROUP BY ALL
), passing AS (
  SELECT *, m / (of + whole - m) AS similarity FROM scored WHERE m / (of + whole - m) >= 0.8
)
SELECT doc_id, item_id, a::INT AS start_word, n_words::INT AS n_words, similarity::DOUBLE AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, a, n_words DESC) AS r FROM passing)
WHERE r = 1
"""
