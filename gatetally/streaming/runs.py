"""Stored batches of a stream, of which readers see the newest complete run.

``run`` names all restarts of a stream from one checkpoint. A fresh start is a new
run: it reads all input again, and until it has come as far as the run before it,
its sums are only part of the truth. So each batch, once its rows are stored, leaves
a commit record with how much input they stand for. A later run takes over when its
records cover as much input as those of the run that readers see, or when it was
closed by ``close_run`` (after the input itself has become smaller). Rows of a batch
without a record, as a writer leaves them that was stopped in between, are not read.

Batches pile up while a stream runs. ``merge_batches`` sums up the committed batches
of the visible run into one stored row set and leaves a record that it stands for all
batches up to a number. The stream goes on writing meanwhile; readers go over to the
merged rows when the record is there. Merged batches may be deleted afterwards.
"""

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatetally.sources.days import found

RUN, BATCH = "run", "batch_id"
VERSION = [T.StructField(RUN, T.LongType()), T.StructField(BATCH, T.LongType())]
#: Kinds of records, and the number that stands for a closed run.
BATCHED, MERGED, CLOSED = "batch", "merged", "closed"
_END = 1 << 62
_RECORD = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("size", T.LongType()), T.StructField("upto", T.LongType())]
    + VERSION
)


def _records_path(path: str) -> str:
    # A leading underscore hides the folder from readers of the rows.
    return f"{path.rstrip('/')}/_batches"


def store_rows(rows: DataFrame, path: str, run: int, batch_id: int, keys: tuple[str, ...] = ()) -> None:
    """Write the folders of one batch; a repeated batch replaces them."""
    versioned = rows.withColumns({RUN: F.lit(run).cast("bigint"), BATCH: F.lit(batch_id).cast("bigint")})
    writer = versioned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys, RUN, BATCH).parquet(path)


def _record(spark: SparkSession, path: str, kind: str, run: int, batch_id: int, size: int = 0, upto: int = -1) -> None:
    row = spark.createDataFrame([(kind, size, upto, run, batch_id)], _RECORD).coalesce(1)
    writer = row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(RUN, BATCH).parquet(_records_path(path))


def stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with their run and batch, committed or not."""
    return spark.read.schema(T.StructType([*schema.fields, *VERSION])).parquet(path)


def commit_batch(spark: SparkSession, path: str, schema: T.StructType, run: int, batch_id: int, size: Column) -> None:
    """Record a stored batch; ``size`` is an aggregate that tells how much input its rows stand for."""
    own = (F.col(RUN) == run) & (F.col(BATCH) == batch_id)
    covered = stored_rows(spark, path, schema).filter(own).agg(size.alias("size")).first()["size"]
    _record(spark, path, BATCHED, run, batch_id, int(covered or 0))


def close_run(spark: SparkSession, path: str, run: int) -> None:
    """Let ``run`` take over, whatever it covers."""
    _record(spark, path, CLOSED, run, _END)


@dataclass(frozen=True)
class View:
    """Which stored batches readers see: those after ``upto`` up to ``last`` of ``run``, and the merged ones before."""

    run: int
    upto: int
    last: int

    def rows(self) -> Column:
        batch = F.col(BATCH)
        after = (batch > self.upto) & (batch <= self.last)
        return (F.col(RUN) == self.run) & (after | (batch == merged_id(self.upto)) if self.upto >= 0 else after)


def merged_id(upto: int) -> int:
    """Where the rows of the batches from 0 to ``upto`` are kept once they are merged."""
    return -1 - upto


def visible(records: list) -> View | None:
    """What readers see by the ``records`` (kind, size, upto, run, batch_id); nothing if there are none."""
    by_run = defaultdict(list)
    for r in records:
        by_run[r[RUN]].append(r)
    shown, covered = None, -1
    for run in sorted(by_run):
        kinds = defaultdict(list)
        for r in by_run[run]:
            kinds[r["kind"]].append(r)
        size = sum(r["size"] for r in kinds[BATCHED])
        if kinds[BATCHED] and (size >= covered or kinds[CLOSED]):
            upto = max((r["upto"] for r in kinds[MERGED]), default=-1)
            shown, covered = View(run, upto, max(r[BATCH] for r in kinds[BATCHED])), size
    return shown


def view(spark: SparkSession, path: str) -> View | None:
    """What readers of ``path`` see now: one row for each batch passes through the driver."""
    records = found(spark, spark.read.schema(_RECORD).parquet, _records_path(path))
    return visible(records.collect()) if records is not None else None


def newest_run(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest complete run; folders of other runs and merged batches are not read."""
    seen = view(spark, path)
    if seen is None:
        return spark.createDataFrame([], schema)
    return stored_rows(spark, path, schema).filter(seen.rows()).select(*schema.fieldNames())


def merge_batches(
    spark: SparkSession, path: str, schema: T.StructType, merged: Callable[[DataFrame], DataFrame]
) -> View | None:
    """Replace the committed batches of the visible run by ``merged`` of their rows."""
    seen = view(spark, path)
    if seen is None or seen.last <= seen.upto:
        return seen
    rows = merged(stored_rows(spark, path, schema).filter(seen.rows()).select(*schema.fieldNames()))
    store_rows(rows.hint("rebalance"), path, seen.run, merged_id(seen.last))
    _record(spark, path, MERGED, seen.run, merged_id(seen.last), upto=seen.last)
    return View(seen.run, seen.last, seen.last)
