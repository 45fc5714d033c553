"""The batch operators on Structured Streaming.

Curation is the batch transform itself. Aggregates use event-time windows with
a watermark; rows later than the watermark are dropped, and so are rows whose
time could not be parsed, which belong to no window.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatetally.functions.rounding import steady_round
from gatetally.operators.curate import server_requests
from gatetally.operators.logqueries import health_measures
from gatetally.operators.traffic import Limits, flag_anomalies

LATENESS = "10 minutes"


def endpoint_hourly_stream(curated: DataFrame, lateness: str = LATENESS, accuracy: int = 10000) -> DataFrame:
    """Requests, latency and worst status per closed hour and path.

    The percentile comes from a sketch, since state must stay bounded.
    """
    return (
        curated.filter(F.col("event_type") == "server_request")
        .withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 hour"), "request_path")
        .agg(*health_measures(accuracy))
        .select(F.col("window.start").alias("hour"), "request_path", *_health_names())
    )


def _health_names() -> list[str]:
    return ["requests", "avg_latency_ms", "max_status", "p95_latency_ms"]


def _by_day(curated: DataFrame, lateness: str) -> tuple[DataFrame, list]:
    requests = server_requests(curated).withWatermark("event_ts", lateness)
    return requests, [F.window("event_ts", "1 day").alias("day"), F.col("ip")]


def _finish(daily: DataFrame, limits: Limits) -> DataFrame:
    named = daily.select(
        F.date_format("day.start", "yyyy-MM-dd").alias("dt"),
        "ip",
        "requests",
        "errors",
        F.lit(0).cast("bigint").alias("purchases"),
        "sessions",
        steady_round(F.col("avg_latency_ms"), 2).alias("avg_latency_ms"),
        F.round("max_latency_ms", 2).alias("max_latency_ms"),
    )
    return flag_anomalies(named, limits)


def ip_anomalies_sketched(
    curated: DataFrame, limits: Limits = Limits(), lateness: str = LATENESS, log_size: int = 14
) -> DataFrame:
    """Anomaly rows of the running day, renewed with every batch (update mode).

    Sessions are counted by a sketch of ``2 ** log_size`` cells, so state is one
    row of bounded size per day and address. Counts up to about 1,500 are exact,
    larger ones off by about 0.8 %. Exact counts: :func:`additive.ip_anomalies`.
    """
    requests, keys = _by_day(curated, lateness)
    daily = requests.groupBy(*keys).agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("status_code") >= 400).alias("errors"),
        F.hll_sketch_estimate(F.hll_sketch_agg("session_id", log_size)).alias("sessions"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
    )
    return _finish(daily, limits)


def _session_sums(curated: DataFrame, lateness: str) -> DataFrame:
    requests, keys = _by_day(curated, lateness)
    return requests.groupBy(*keys, "session_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("status_code") >= 400).alias("bad"),
        F.sum("latency_ms").alias("time"),
        F.count("latency_ms").alias("timed"),
        F.max("latency_ms").alias("slowest"),
    )


def _over_sessions(per_session: DataFrame, limits: Limits) -> DataFrame:
    daily = per_session.groupBy("day", "ip").agg(
        F.sum("n").alias("requests"),
        F.sum("bad").alias("errors"),
        F.count("session_id").alias("sessions"),
        F.try_divide(F.sum("time"), F.sum("timed")).alias("avg_latency_ms"),
        F.max("slowest").alias("max_latency_ms"),
    )
    return _finish(daily, limits)


def ip_anomalies_closed(curated: DataFrame, limits: Limits = Limits(), lateness: str = LATENESS) -> DataFrame:
    """Exact anomaly rows of each day once it has closed (append mode).

    Requests are first summed per day, address and session and those sums per
    day and address, which counts sessions exactly and spreads a busy address
    over its sessions.
    """
    return _over_sessions(_session_sums(curated, lateness), limits)
