"""Daily conversion funnel over browser sessions."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.operators.curate import client_events


def session_flags(curated: DataFrame) -> DataFrame:
    """Per day and session, 1 or 0 for each funnel step seen in it."""
    seen = [
        F.max(F.col("event_type").eqNullSafe(step).cast("int")).alias(f"has_{name}")
        for step, name in S.FUNNEL_STEPS.items()
    ]
    return client_events(curated).groupBy("dt", "session_id").agg(*seen)


def funnel_daily(curated: DataFrame, ordered: bool = True) -> DataFrame:
    """Sessions reaching each step per day, and the share that bought.

    Flags are independent, so a day's counts need not fall from step to step.
    """
    steps = [F.sum(f"has_{n}").alias(f"sessions_{n}") for n in S.FUNNEL_STEPS.values()]
    days = (
        session_flags(curated)
        .groupBy("dt")
        .agg(F.count("*").alias("sessions_total"), *steps)
        .select(
            "*",
            F.round(F.col("sessions_purchase") / F.col("sessions_total"), 6).alias("conversion_rate"),
            F.lit("funnel").alias("metric"),
        )
    )
    return days.orderBy("dt") if ordered else days


def funnel_checks(funnel: DataFrame) -> DataFrame:
    """One row per documented check with the number of days that break it."""
    never_more = [
        ("purchase_le_checkout", "sessions_purchase", "sessions_begin_checkout"),
        ("checkout_le_detail", "sessions_begin_checkout", "sessions_event_detail"),
        ("detail_le_total", "sessions_event_detail", "sessions_total"),
    ]
    broken = {name: F.col(small) > F.col(large) for name, small, large in never_more}
    broken["rate_within_0_1"] = ~F.col("conversion_rate").between(0, 1)
    counts = funnel.agg(
        *[F.count_if(cond).alias(name) for name, cond in broken.items()],
        F.count("*").alias("days"),
    )
    return counts.unpivot(["days"], list(broken), "check_name", "violations").select(
        "check_name", "days", "violations"
    )


def known_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts that were taken while writing, in the form of :func:`layer_counts`."""
    return spark.createDataFrame(list(counts.items()), "layer string, n_rows bigint")


def layer_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named frame with its row count, in one job.

    Count frames that were read back from storage: that touches file footers
    only, where counting the transform would run it a second time.
    """
    parts = [df.agg(F.lit(name).alias("layer"), F.count("*").alias("n_rows")) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)
