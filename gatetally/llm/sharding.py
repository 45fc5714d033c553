"""Sharding by jump consistent hashing (operator 8, built-in expressions only).

A stable 64-bit key and the number of shards alone decide a row's shard: the
jump hash walks a pseudo-random sequence seeded with the key and keeps the last
jump below the shard count. No ring or table exists, and one more shard takes
1/(n+1) of the rows, all of them into itself.

Within a shard, rows are numbered without gaps in key order. A shard is never
numbered by one task: rows are cut into key ranges (``cuts`` quantiles of the
key), numbered within (shard, range), and moved by the number of rows in earlier
ranges of the shard. That table has at most shards x cuts rows, whatever the
input, so it may be broadcast.

Defined results: a null text has no bytes; a null key counts as key 0 and comes
first in its shard; equal keys share a shard and are numbered by size, then by
checksum; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gatetally.llm.shared import documents, whole_text

#: The multiplier of the 64-bit linear congruential generator.
MULTIPLIER = 2862933555777941757
#: Longest array of key quantiles; bounds the table of offsets.
CUTS = 256

_LOW22, _LOW20 = (1 << 22) - 1, (1 << 20) - 1


def next_state(key: Column) -> Column:
    """``key * MULTIPLIER + 1`` modulo 2^64 in limbs of 22, 22 and 20 bits, which cannot overflow."""
    k0, k1, k2 = (
        key.bitwiseAND(F.lit(_LOW22)),
        F.shiftrightunsigned(key, 22).bitwiseAND(F.lit(_LOW22)),
        F.shiftrightunsigned(key, 44),
    )
    m0, m1, m2 = (F.lit(x) for x in (MULTIPLIER & _LOW22, MULTIPLIER >> 22 & _LOW22, MULTIPLIER >> 44))
    r0 = k0 * m0 + 1
    r1 = k0 * m1 + k1 * m0 + F.shiftrightunsigned(r0, 22)
    r2 = k0 * m2 + k1 * m1 + k2 * m0 + F.shiftrightunsigned(r1, 22)
    return (
        r0.bitwiseAND(F.lit(_LOW22))
        .bitwiseOR(F.shiftleft(r1.bitwiseAND(F.lit(_LOW22)), 22))
        .bitwiseOR(F.shiftleft(r2.bitwiseAND(F.lit(_LOW20)), 44))
    )


def jump_shards(key: Column, shards: int) -> Column:
    """Struct (shard, grown): the shard among ``shards`` and among one more.

    Both come from one walk, as the sequence of jumps does not depend on the
    number of shards. Every jump goes up, so ``shards + 1`` steps are enough.
    """
    start = F.struct(
        F.lit(0).cast("long").alias("shard"),
        F.lit(-1).cast("long").alias("grown"),
        F.lit(0).cast("long").alias("jump"),
        key.alias("state"),
    )

    def step(at: Column, _: Column) -> Column:
        state = next_state(at["state"])
        draw = F.shiftrightunsigned(state, 33) + 1
        jump = F.floor((at["jump"] + 1) * (F.lit(float(1 << 31)) / draw.cast("double")))
        return F.when(
            at["jump"] <= shards,
            F.struct(
                F.when(at["jump"] < shards, at["jump"]).otherwise(at["shard"]).alias("shard"),
                at["jump"].alias("grown"),
                jump.cast("long").alias("jump"),
                state.alias("state"),
            ),
        ).otherwise(at)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step)


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``, by a tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < bounds[middle], tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(bounds))


def shard_rows(
    rows: DataFrame, shards: int, key: str = "doc_id", order: tuple[str, ...] = (), cuts: int = CUTS
) -> DataFrame:
    """``rows`` with ``shard``, ``grown_shard`` and ``slot``.

    ``order`` names the columns that number rows of equal keys.
    """
    quantiles = rows.agg(F.percentile_approx(key, [i / cuts for i in range(1, cuts)], 10 * cuts).alias("q"))
    bounds = sorted(set(quantiles.head()["q"] or []))
    seed = F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long"))
    placed = F.struct(jump_shards(seed, shards).alias("to"), range_of(seed, bounds).alias("cut"))
    at = ("_at.to.shard", "_at.cut")
    dealt = rows.withColumn("_at", placed)
    counts = dealt.groupBy(F.col(at[0]).alias("_shard"), F.col(at[1]).alias("_cut")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_shard").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_shard", "_cut", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_shard", "_cut").orderBy(F.col(key).asc_nulls_first(), *order)
    return (
        dealt.select(
            "*", F.col(at[0]).alias("_shard"), F.col(at[1]).alias("_cut"), F.col("_at.to.grown").alias("_grown")
        )
        .drop("_at")
        .withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(offsets), ["_shard", "_cut"])
        .withColumn("slot", (F.col("_before") + F.col("_row") - 1).cast("long"))
        .withColumn("shard", F.col("_shard").cast("int"))
        .withColumn("grown_shard", F.col("_grown").cast("int"))
        .drop("_shard", "_cut", "_grown", "_row", "_before")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15, and where each would be among 17."""
    text = whole_text()
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = shard_rows(rows, 16, "doc_id", ("size", "text_crc32"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


#: The checksum runs over the bytes of a text with the reflected polynomial 0xEDB88320.
OP8_SQL = """
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), sums AS (
  SELECT doc_id, strlen(text) + 1 AS size, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(strlen(text)),
        lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM texts, crc_table
), walk AS (
  SELECT doc_id, coalesce(doc_id, 0)::HUGEINT AS state, -1::BIGINT AS b, 0::BIGINT AS j FROM documents
  UNION ALL
  SELECT doc_id, next, j, floor((j + 1) * (2147483648.0::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM walk WHERE j < 17)
), places AS (
  SELECT doc_id, max(b) FILTER (b < 16) AS shard, max(b) AS grown FROM walk GROUP BY doc_id
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown::INT AS grown_shard
FROM sums JOIN places USING (doc_id)
"""
