"""Endpoint health whose percentiles merge over any range of hours.

Each micro-batch stores, for every hour and path, counts, the latency sum, the worst
status and a KLL sketch of the latencies (a few kilobytes, however many requests).
Sketches of different batches, hours or paths merge into one of the same size and
error: the rank of a percentile is off by about ``2.6 / k`` of the group at most (99 %
confidence), however many merges there were. So a week's percentile reads 168 small
rows a path, not the requests. Requests without a time have a null hour. Latencies that
are not numbers (NaN) count as requests without a latency.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gatetally.functions.rounding import exact_sum
from gatetally.operators.logqueries import HOURLY, in_hours
from gatetally.streaming import runs
from gatetally.streaming.sinks import start_batches

#: Size of a sketch; the rank error falls with it.
K = 400

ENDPOINT_SKETCHES = T.StructType(
    [T.StructField("hour", T.TimestampType()), T.StructField("request_path", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("n", "timed")]
    + [T.StructField("time", T.DoubleType()), T.StructField("max_status", T.IntegerType())]
    + [T.StructField("sketch", T.BinaryType())]
)


def endpoint_sketches(curated: DataFrame, k: int = K) -> DataFrame:
    """Server requests per hour and path: what merges."""
    latency = F.when(~F.isnan("latency_ms"), F.col("latency_ms"))
    requests = in_hours(curated).filter(F.col("event_type") == "server_request").withColumn("latency", latency)
    return requests.groupBy(*HOURLY).agg(
        F.count("*").alias("n"),
        F.count("latency").alias("timed"),
        exact_sum(F.col("latency")).alias("time"),
        F.max("status_code").alias("max_status"),
        F.kll_sketch_agg_double("latency", k).alias("sketch"),
    )


def merged_sketches(rows: DataFrame, keys: list[str] | None = None, k: int = K) -> DataFrame:
    """Stored rows brought together by ``keys``; any of hour and path, or none."""
    return rows.groupBy(*(HOURLY if keys is None else keys)).agg(
        F.sum("n").alias("n"),
        F.sum("timed").alias("timed"),
        exact_sum(F.col("time")).alias("time"),
        F.max("max_status").alias("max_status"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
    )


def store_endpoint_sketches(
    curated: DataFrame, path: str, checkpoint: str, run: int = 0, every: str | None = None, k: int = K
) -> StreamingQuery:
    def write(rows: DataFrame, batch_id: int) -> None:
        runs.store_rows(endpoint_sketches(rows, k), path, run, batch_id)
        runs.commit_batch(rows.sparkSession, path, ENDPOINT_SKETCHES, run, batch_id, F.sum("n"))

    return start_batches(curated, write, checkpoint, every)


def endpoint_percentiles(
    spark: SparkSession,
    path: str,
    percents: tuple[int, ...] = (50, 95, 99),
    first: datetime | None = None,
    last: datetime | None = None,
    keys: tuple[str, ...] = ("request_path",),
    k: int = K,
) -> DataFrame:
    """Health per ``keys`` over the hours from ``first`` up to but not including ``last``.

    Without bounds all hours count, and requests without a time too.
    """
    rows = runs.newest_run(spark, path, ENDPOINT_SKETCHES)
    if first is not None:
        rows = rows.filter(F.col("hour") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("hour") < F.lit(last))
    merged = merged_sketches(rows, list(keys), k)
    told = {
        f"p{p}_latency_ms": F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100)))
        for p in percents
    }
    return merged.select(
        *keys,
        F.col("n").alias("requests"),
        F.try_divide("time", "timed").alias("avg_latency_ms"),
        "max_status",
        *[column.alias(name) for name, column in told.items()],
    )
