"""Streams that store what adds up, so that reading them equals the batch form.

Each micro-batch is a small batch job: it writes its own sums to a folder of its
number. There is no event-time state and no watermark, so late rows and rows
without a time count like any other. A repeated batch replaces its folder. Which
batches readers see, also while a fresh start reads all input again, is the
business of :mod:`gatetally.streaming.runs`.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gatetally import schemas as S
from gatetally.functions.rounding import steady_round
from gatetally.operators.curate import server_requests
from gatetally.operators.logqueries import HOURLY, health_counts, health_of_counts, in_hours
from gatetally.operators.traffic import Limits, flag_anomalies
from gatetally.streaming import runs
from gatetally.streaming.sinks import start_batches

SESSION_SUMS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("dt", "ip", "session_id")]
    + [T.StructField(c, T.LongType()) for c in ("n", "bad", "timed")]
    + [T.StructField(c, T.DoubleType()) for c in ("time", "slowest")]
)


ENDPOINT_COUNTS = T.StructType(
    [T.StructField("hour", T.TimestampType()), T.StructField("request_path", T.StringType())]
    + [S.CLICK_CURATED[c] for c in ("latency_ms", "status_code")]
    + [T.StructField("n", T.LongType())]
)


def session_sums(curated: DataFrame) -> DataFrame:
    """Server requests summed per settled day, address and session."""
    return (
        server_requests(curated)
        .groupBy("dt", "ip", "session_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("status_code") >= 400).alias("bad"),
            F.count("latency_ms").alias("timed"),
            F.sum("latency_ms").alias("time"),
            F.max("latency_ms").alias("slowest"),
        )
    )


def sums_writer(
    summed: Callable[[DataFrame], DataFrame], schema: T.StructType, path: str, run: int
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the sums of each batch and then records it.

    A batch stands for as much input as its sums count rows (column ``n``).
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        runs.store_rows(summed(rows), path, run, batch_id)
        runs.commit_batch(rows.sparkSession, path, schema, run, batch_id, F.sum("n"))

    return write


def store_session_sums(
    curated: DataFrame, path: str, checkpoint: str, run: int = 0, every: str | None = None
) -> StreamingQuery:
    return start_batches(curated, sums_writer(session_sums, SESSION_SUMS, path, run), checkpoint, every)


def merged_sessions(sums: DataFrame) -> DataFrame:
    """Session sums of several batches as those of one."""
    added = [F.sum(c).alias(c) for c in ("n", "bad", "timed", "time")]
    return sums.groupBy("dt", "ip", "session_id").agg(*added, F.max("slowest").alias("slowest"))


def ip_anomalies(spark: SparkSession, path: str, limits: Limits = Limits()) -> DataFrame:
    """The anomaly metric of all that has arrived, exactly as in batch.

    The sums of all batches meet per session before they meet per address, so a
    session counts once, and a busy address is spread over its sessions.
    """
    per_session = merged_sessions(runs.newest_run(spark, path, SESSION_SUMS))
    daily = per_session.groupBy("dt", "ip").agg(
        F.sum("n").alias("requests"),
        F.sum("bad").alias("errors"),
        F.lit(0).cast("bigint").alias("purchases"),
        F.count("session_id").alias("sessions"),
        steady_round(F.try_divide(F.sum("time"), F.sum("timed")), 2).alias("avg_latency_ms"),
        F.round(F.max("slowest"), 2).alias("max_latency_ms"),
    )
    return flag_anomalies(daily, limits)


def endpoint_counts(curated: DataFrame) -> DataFrame:
    """Server requests counted per hour, path, latency and status; those without a time have a null hour."""
    return health_counts(in_hours(curated), HOURLY)


def merged_endpoints(counts: DataFrame) -> DataFrame:
    """Endpoint counts of several batches as those of one."""
    return counts.groupBy(*HOURLY, "latency_ms", "status_code").agg(F.sum("n").alias("n"))


def store_endpoint_counts(
    curated: DataFrame, path: str, checkpoint: str, run: int = 0, every: str | None = None
) -> StreamingQuery:
    return start_batches(curated, sums_writer(endpoint_counts, ENDPOINT_COUNTS, path, run), checkpoint, every)


def endpoint_hourly(spark: SparkSession, path: str) -> DataFrame:
    """Health per hour and path of all that has arrived, exactly as in batch."""
    return health_of_counts(merged_endpoints(runs.newest_run(spark, path, ENDPOINT_COUNTS)), HOURLY)
