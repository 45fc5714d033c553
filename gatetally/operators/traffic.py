"""Request traffic per address or endpoint, and rule-based anomalies."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatetally.functions.rounding import steady_round
from gatetally.operators.curate import server_requests


@dataclass(frozen=True)
class Limits:
    """The limits from which traffic counts as anomalous."""

    requests: int = 100
    errors: int = 5
    latency_ms: float = 1000
    few_sessions: int = 2
    repeated_requests: int = 50


def daily_traffic(curated: DataFrame, key: str = "ip") -> DataFrame:
    """Requests, errors, sessions and latency per day and ``key``.

    ``purchases`` belongs to the table's contract. It is always 0, because only
    server requests are counted here.

    The distinct count is planned as two steps, first by day, key and session,
    so a key with a third of the requests is spread over its sessions.
    """
    return (
        server_requests(curated)
        .groupBy("dt", key)
        .agg(
            F.count("*").alias("requests"),
            F.count_if(F.col("status_code") >= 400).alias("errors"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
            F.countDistinct("session_id").alias("sessions"),
            steady_round(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
            F.round(F.max("latency_ms"), 2).alias("max_latency_ms"),
        )
    )


def _rules(limits: Limits) -> dict[str, Column]:
    """Label of each rule, in the order the reasons are listed."""
    requests = F.col("requests")
    # The labels and their order.
    return {
        "high_requests": requests >= limits.requests,
        "many_errors": F.col("errors") >= limits.errors,
        "high_latency": F.col("avg_latency_ms") >= limits.latency_ms,
        "repetitive_ip": (F.col("sessions") <= limits.few_sessions) & (requests >= limits.repeated_requests),
    }


def flag_anomalies(traffic: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Add ``is_anomaly`` and the comma-separated ``reason``.

    Without any latency the flag is null unless another rule holds, while the
    reason still reads ``normal``.
    """
    rules = _rules(limits)
    any_rule = None
    for hit in rules.values():
        any_rule = hit if any_rule is None else any_rule | hit
    labels = F.concat_ws(",", *[F.when(hit, F.lit(label)) for label, hit in rules.items()])
    return traffic.select(
        "*",
        any_rule.alias("is_anomaly"),
        F.coalesce(F.nullif(labels, F.lit("")), F.lit("normal")).alias("reason"),
    )


def anomalies(curated: DataFrame, limits: Limits = Limits(), ordered: bool = True) -> DataFrame:
    """Daily traffic per address with flags, flagged and busiest first.

    Day and address complete the order: most rows tie in the first two columns,
    and rows that tie in all cannot be split between sorting tasks.
    """
    flagged = flag_anomalies(daily_traffic(curated), limits)
    return flagged.orderBy(F.desc("is_anomaly"), F.desc("requests"), "dt", "ip") if ordered else flagged


def flagged_rows(flagged: DataFrame) -> DataFrame:
    """All flagged rows."""
    return flagged.filter("is_anomaly")


def anomalies_flagged(flagged: DataFrame, n: int) -> DataFrame:
    """A report of the ``n`` busiest flagged rows; day and address break ties."""
    return flagged_rows(flagged).orderBy(F.desc("requests"), "dt", "ip").limit(n)


def endpoint_anomalies(curated: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The same rules per day and requested path."""
    return flag_anomalies(daily_traffic(curated, "request_path"), limits)
