"""Copies removed from a stream, however far apart they arrive.

Rows kept are stored by day, bucket of their digest, run and batch. Beside them,
each batch leaves Bloom filters of its digests, one of ``32,768`` bits for each day
and cell of the hash. A new batch first asks the filters of its own days: only where
one says that a digest may be there are the digests of that day and bucket read, and
compared. The days and buckets to open become literal partition filters, so other
folders are not even listed for reading. A batch without copies reads filters alone.

A filter never denies a digest that it has, so no copy gets through; a wrong "maybe"
costs reading a bucket. Filters are written before the rows: if a writer stops in
between, there are only filters too many.

Copies agree in every contract column and so in their day. A day that is no ISO date
goes to ``other``, so that odd texts make no folders.
"""

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gatetally import schemas as S
from gatetally.operators.curate import with_missing
from gatetally.streaming.runs import BATCH, RUN, VERSION, store_rows
from gatetally.streaming.sinks import start_batches

DAY, BUCKET, DIGEST, CELL = "day", "bucket", "digest", "cell"
#: Folders of a day, filters of a day, and bits that a digest sets.
BUCKETS, CELLS, PROBES = 4, 256, 3
#: Fixed value: the bits of a filter that Spark's bitmap aggregates build.
_BITS = 32768

_KEYS = [T.StructField(DAY, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
STORED = T.StructType([*S.CLICK_RAW.fields, T.StructField(DIGEST, T.StringType()), *_KEYS, *VERSION])
FILTERS = T.StructType(
    [T.StructField(BUCKET, T.IntegerType()), T.StructField(CELL, T.IntegerType())]
    + [T.StructField("bits", T.BinaryType()), _KEYS[0], *VERSION]
)


def _filters_path(path: str) -> str:
    return f"{path.rstrip('/')}/_filters"


def keyed_rows(rows: DataFrame) -> DataFrame:
    """One of each set of equal rows of a batch, with day, digest, bucket and cell."""
    names = S.CLICK_RAW.fieldNames()
    text = with_missing(rows, S.CLICK_RAW).select(*names)
    iso = F.coalesce(F.col("dt").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    named = text.withColumns(
        {
            DIGEST: F.sha2(F.to_json(F.struct(*names)), 256),
            DAY: F.when(iso, F.col("dt")).otherwise("other"),
        }
    )
    spread = F.pmod(F.xxhash64(DIGEST), F.lit(BUCKETS * CELLS)).cast("int")
    return named.dropDuplicates([DAY, DIGEST]).withColumns({BUCKET: spread % BUCKETS, CELL: F.floor(spread / BUCKETS).cast("int")})


def _places() -> Column:
    """The bits that a digest sets."""
    return F.array(*[F.pmod(F.xxhash64(F.col(DIGEST), F.lit(i)), F.lit(_BITS)).cast("int") for i in range(1, PROBES + 1)])


def filters_of(keyed: DataFrame) -> DataFrame:
    """(day, bucket, cell, bits): the filters of a batch."""
    placed = keyed.select(DAY, BUCKET, CELL, F.explode(_places()).alias("place"))
    return placed.groupBy(DAY, BUCKET, CELL).agg(F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("bits"))


def _has(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, place % 8) == 1


def may_have(keyed: DataFrame, filters: DataFrame) -> DataFrame:
    """(day, bucket): where rows of a batch may have been stored before."""
    asked = keyed.select(DAY, BUCKET, CELL, _places().alias("places"))
    told = asked.join(filters.select(DAY, BUCKET, CELL, "bits"), [DAY, BUCKET, CELL])
    every = reduce(lambda a, b: a & b, [_has(F.col("bits"), F.col("places")[i]) for i in range(PROBES)])
    return told.filter(every).select(DAY, BUCKET).distinct()


def _in_folders(places: list) -> Column:
    """Literal partition filter for the given (day, bucket) rows."""
    by_day: dict[str, list[int]] = {}
    for r in places:
        by_day.setdefault(r[DAY], []).append(r[BUCKET])
    parts = [(F.col(DAY) == day) & F.col(BUCKET).isin(sorted(buckets)) for day, buckets in sorted(by_day.items())]
    return reduce(or_, parts) if parts else F.lit(False)


def seen_digests(keyed: DataFrame, path: str, run: int, batch_id: int) -> DataFrame:
    """(day, digest) of what other batches have stored in the folders where this batch's digests may be."""
    spark = keyed.sparkSession
    others = ~((F.col(RUN) == run) & (F.col(BATCH) >= batch_id))
    days = [r[DAY] for r in keyed.select(DAY).distinct().collect()]
    filters = spark.read.schema(FILTERS).parquet(_filters_path(path)).filter(F.col(DAY).isin(days) & others)
    folders = may_have(keyed, filters).collect()  # at most the batch's days times BUCKETS
    return spark.read.schema(STORED).parquet(path).filter(_in_folders(folders) & others).select(DAY, DIGEST)


def distinct_writer(path: str, run: int) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the rows of each batch that no other batch has stored."""

    def write(rows: DataFrame, batch_id: int) -> None:
        keyed = keyed_rows(rows).persist()
        try:
            store_rows(filters_of(keyed), _filters_path(path), run, batch_id, (DAY,))
            fresh = keyed.drop(CELL).join(seen_digests(keyed, path, run, batch_id), [DAY, DIGEST], "left_anti")
            # A folder is a day and a bucket: rows of one come together before they are written.
            store_rows(fresh.hint("rebalance", F.col(DAY), F.col(BUCKET)), path, run, batch_id, (DAY, BUCKET))
        finally:
            keyed.unpersist()

    return write


def store_distinct_rows(
    raw: DataFrame, path: str, checkpoint: str, run: int = 0, every: str | None = None
) -> StreamingQuery:
    """Keep one of each set of equal raw rows, however far apart they arrive."""
    spark = raw.sparkSession
    for schema, place, keys in ((STORED, path, (DAY, BUCKET)), (FILTERS, _filters_path(path), (DAY,))):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*keys, RUN, BATCH).parquet(place)
    return start_batches(raw, distinct_writer(path, run), checkpoint, every)


def distinct_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that :func:`store_distinct_rows` has kept."""
    return spark.read.schema(STORED).parquet(path).select(*S.CLICK_RAW.fieldNames())
