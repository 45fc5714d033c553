"""Exact percentile per group without collecting a group in one task."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cells per factor e of the value range: each is 0.025 % wide.
CELLS_PER_E = 4096
_OFFSET = 1 << 23


def _cell(value: Column) -> Column:
    """Number of the narrow value range that holds ``value``; never decreasing
    in it. NaN comes last, as in Spark's own order; null stays null."""
    size = F.least(F.ln(F.abs(value)), F.lit(800.0))
    steps = F.floor(size * CELLS_PER_E) + _OFFSET
    return (
        F.when(F.isnan(value), F.lit(4 * _OFFSET).cast("bigint"))
        .when(value > 0, steps)
        .when(value < 0, -steps)
        .when(value == 0, F.lit(0).cast("bigint"))
    )


def _running(counts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Add ``_upto``: rows of the group up to this one, nulls last."""
    upto = (
        Window.partitionBy(*keys)
        .orderBy(F.col(by).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return counts.withColumn("_upto", F.sum("_n").over(upto))


def _join_nullsafe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join in which null keys match each other; keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_{k}_right" for k in keys})
    matches = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}_right")) for k in keys])
    return left.join(renamed, matches).drop(*[f"_{k}_right" for k in keys])


def exact_percentile(
    counts: DataFrame,
    keys: list[str],
    value: str,
    weight: str,
    percent: int,
    name: str,
    totals: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Per group the smallest value with at least ``percent`` percent of the
    group's values at or below it; null if the group has no value.

    ``counts`` holds values that have collapsed already: ``weight`` rows each.
    Those are counted by narrow cells of the value range first. Only the cell
    that holds the wanted rank is looked into, so no task sorts more than a
    group's cells or one cell's values.

    ``totals`` are sums or maxima wanted per group besides, as ``"sum"`` or
    ``"max"`` and an expression on ``counts``; they ride along with the cells.
    """
    fold = {"sum": F.sum, "max": F.max}
    pool = counts.withColumns({"_cell": _cell(F.col(value)), "_n": F.col(weight)})
    per_cell = pool.groupBy(*keys, "_cell").agg(
        F.sum("_n").alias("_n"), *[fold[kind](expr).alias(t) for t, (kind, expr) in totals.items()]
    )

    group = Window.partitionBy(*keys)
    valued = F.sum(F.when(F.col("_cell").isNotNull(), F.col("_n")).otherwise(0)).over(group)
    ranked = _running(per_cell, keys, "_cell").withColumns(
        {
            "_rank": F.ceil(valued * percent / F.lit(100)).cast("bigint"),
            **{t: fold[kind](t).over(group) for t, (kind, _) in totals.items()},
        }
    )
    holds_rank = (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
    wanted = ranked.filter(holds_rank | (F.col("_rank") == 0)).select(
        *keys, "_cell", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"), *totals
    )

    inside = _join_nullsafe(pool.select(*keys, "_cell", value, "_n"), wanted, [*keys, "_cell"])
    reached = _running(inside, keys, value).filter(F.col("_upto") >= F.col("_rank"))
    return reached.groupBy(*keys).agg(F.min(value).alias(name), *[F.max(t).alias(t) for t in totals])
