"""Layers in which whole days are replaced at once.

Rows of a write go to a folder of their own (``rows/stage=…``) that no reader
looks into yet. Then one commit record, a single small file, names the stage and
the days it replaces. A reader takes every day from the newest record that names
it, so it sees the old rows of a day or the new ones, never a mix and never both:
a group that the new rows no longer have (another event type, an address that is
not flagged any more) goes with its day. A writer that dies before its record has
changed nothing that can be seen.

Records are numbered on from the newest one. Writers of one layer take turns; two
that commit the same number are told apart by their stage, for every reader alike.

The records of a layer, one row for each write, pass through the driver when it is
read, and become literal partition filters: stages and days that are not wanted
are never listed. ``rewrite_days`` starts a layer afresh when there are many.
"""

import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGE, DAY = "stage", "dt"
_RECORD = "number bigint, stage string, whole boolean, days array<string>"


def _rows(path: str) -> str:
    return f"{path.rstrip('/')}/rows"


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/commits"


def found(spark: SparkSession, read: Callable[[str], DataFrame], path: str) -> DataFrame | None:
    """What ``read`` gives for a path of any file system that Spark knows, or nothing where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return read(path) if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place) else None


def _records(spark: SparkSession, path: str) -> list:
    """Commit records in their order."""
    records = found(spark, spark.read.schema(_RECORD).json, _commits(path))
    return sorted(records.collect(), key=lambda r: (r["number"], r["stage"])) if records is not None else []


def kept_by_day(spark: SparkSession, path: str) -> bool:
    """Whether a layer was written by this module."""
    return found(spark, spark.read.schema(_RECORD).json, _commits(path)) is not None


def stage_days(df: DataFrame, path: str, keys: tuple[str, ...]) -> str:
    """Write rows where no reader sees them; returns the name of the stage."""
    stage = uuid.uuid4().hex
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .withColumn(STAGE, F.lit(stage))
        .write.mode("append")
        .partitionBy(STAGE, *keys)
        .parquet(_rows(path))
    )
    return stage


def commit_days(spark: SparkSession, path: str, stage: str, days: Iterable[str | None] | None = None) -> None:
    """Let a stage replace ``days``, or the whole layer if none are given."""
    before = _records(spark, path)
    record = (before[-1]["number"] + 1 if before else 0, stage, days is None, None if days is None else list(days))
    # One row in one file: it appears as a whole or not at all.
    spark.createDataFrame([record], _RECORD).coalesce(1).write.mode("append").json(_commits(path))


def write_days(
    df: DataFrame, path: str, keys: tuple[str, ...], days: Iterable[str | None] | None = None, whole: bool = False
) -> None:
    """Replace days of a layer partitioned by ``keys``, of which ``dt`` is the first.

    Replaced are the ``days`` named (a day without rows becomes empty), else those
    that ``df`` has rows for, or with ``whole`` all of them. Rows of other days
    than those named are an error, as they would stay unseen.
    """
    if keys[0] != DAY:
        raise ValueError(f"the first key of a layer kept by day is {DAY}, not {keys[0]}")
    spark = df.sparkSession
    stage = stage_days(df, path, keys)
    if whole:
        commit_days(spark, path, stage)
        return
    written = spark.read.schema(T.StructType([df.schema[DAY], T.StructField(STAGE, T.StringType())])).parquet(_rows(path))
    there = {r[DAY] for r in written.filter(F.col(STAGE) == stage).select(DAY).distinct().collect()}
    if days is not None and there - set(days):
        raise ValueError(f"rows of days that were not to be replaced: {sorted(map(str, there - set(days)))}")
    commit_days(spark, path, stage, there if days is None else days)


def current_stages(records: list) -> tuple[str | None, dict[str, list]]:
    """The newest stage that replaced everything, and the days of each later stage that are still its own.

    Days of the first that later stages have replaced are among the latter's
    days or those of one replaced in turn: they are all the days named here.
    """
    base, owner = None, {}
    for r in records:
        if r["whole"]:
            base, owner = r["stage"], {}
        else:
            owner |= {day: r["stage"] for day in r["days"]}
    by_stage = defaultdict(list)
    for day, stage in owner.items():
        by_stage[stage].append(day)
    return base, dict(by_stage)


def _on(days: list) -> Column:
    """The day is one of ``days``, of which one may be null."""
    named = [d for d in days if d is not None]
    hit = F.coalesce(F.col(DAY).isin(named), F.lit(False)) if named else F.lit(False)
    return hit | F.col(DAY).isNull() if None in days else hit


def read_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest rows of every day."""
    records = _records(spark, path)
    if not records:
        return spark.createDataFrame([], schema)
    base, by_stage = current_stages(records)
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField(STAGE, T.StringType())])).parquet(_rows(path))
    parts = [(F.col(STAGE) == stage) & _on(days) for stage, days in by_stage.items()]
    if base is not None:
        replaced = [d for days in by_stage.values() for d in days]
        parts.append((F.col(STAGE) == base) & ~_on(replaced) if replaced else F.col(STAGE) == base)
    seen = reduce(or_, parts) if parts else F.lit(False)
    return stored.filter(seen).select(*schema.fieldNames())


def rewrite_days(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: tuple[str, ...]) -> None:
    """Write the current rows to a new layer with one stage; ``path`` may be deleted once nobody reads it."""
    write_days(read_days(spark, path, schema), target, keys, whole=True)
