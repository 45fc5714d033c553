"""The saved log queries and dashboard tables, over curated clickstream.

Their rules differ from the batch metrics on purpose: the funnel counts only
the four steps, and suspected bots use strict limits and no error rule. Each
order is completed by the group's keys, so that ties can be sorted in parallel.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.functions.rounding import exact_sum
from gatetally.operators.percentile import exact_percentile

PERCENT = 95
HOURLY = ["hour", "request_path"]
# Above these an address is suspected to be a bot.
BOT_REQUESTS, BOT_REPEATED, BOT_LATENCY_MS, BOT_FEW_SESSIONS = 100, 50, 1000, 2


def _from_browser(curated: DataFrame, kinds: list[str]) -> DataFrame:
    return curated.filter((F.col("source") == "client") & F.col("event_type").isin(kinds))


def _from_server(curated: DataFrame) -> DataFrame:
    return curated.filter(F.col("event_type") == "server_request")


def step_sessions(curated: DataFrame) -> DataFrame:
    """Q1: distinct sessions per day and funnel step."""
    return (
        _from_browser(curated, list(S.FUNNEL_STEPS))
        .groupBy("dt", "event_type")
        .agg(F.countDistinct("session_id").alias("sessions"))
        .orderBy("dt", "event_type")
    )


def interest_and_revenue(curated: DataFrame) -> DataFrame:
    """Q2: events and revenue per day, event and kind; no amount, no revenue."""
    return (
        _from_browser(curated, ["view_event_detail", "purchase"])
        .filter(F.col("event_id").isNotNull())
        .groupBy("dt", "event_id", "event_type")
        .agg(F.count("*").alias("events"), exact_sum(F.col("amount")).alias("revenue_total"))
        .orderBy("dt", F.desc("events"), "event_id", "event_type")
    )


def health_counts(curated: DataFrame, keys: list[str]) -> DataFrame:
    """Server requests counted per key, latency and status."""
    return _from_server(curated).groupBy(*keys, "latency_ms", "status_code").agg(F.count("*").alias("n"))


def health_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Exact health of the keys from what :func:`health_counts` gives.

    Requests collapse to one row per latency and status before anything else.
    That grouping is used twice, for the cells and for the values of one cell.
    The status is one of its keys, so that both uses read the same columns and
    share one scan and one shuffle.
    """
    n, latency = F.col("n"), F.col("latency_ms")
    totals = {
        "requests": ("sum", n),
        "time": ("sum", latency * n),
        "timed": ("sum", F.when(latency.isNotNull(), n)),
        "max_status": ("max", F.col("status_code")),
    }
    found = exact_percentile(counts, keys, "latency_ms", "n", PERCENT, "p95_latency_ms", totals)
    mean = F.try_divide("time", "timed").alias("avg_latency_ms")
    return found.select(*keys, "requests", mean, "max_status", "p95_latency_ms")


def _quick_health(requests: DataFrame, keys: list[str], accuracy: int) -> DataFrame:
    return requests.groupBy(*keys).agg(*health_measures(accuracy))


def health_measures(accuracy: int = 10000) -> list[Column]:
    """Requests, latency and worst status as aggregates of bounded size."""
    return [
        F.count("*").alias("requests"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.max("status_code").alias("max_status"),
        F.percentile_approx("latency_ms", PERCENT / 100, accuracy).alias("p95_latency_ms"),
    ]


def _health(curated: DataFrame, keys: list[str], exact: bool, accuracy: int) -> DataFrame:
    if exact:
        return health_of_counts(health_counts(curated, keys), keys)
    return _quick_health(_from_server(curated), keys, accuracy)


def in_hours(curated: DataFrame) -> DataFrame:
    return curated.withColumn("hour", F.date_trunc("hour", "event_ts"))


def endpoint_hourly(curated: DataFrame, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Q3: requests, mean and 95th percentile latency and highest status per
    hour and path, latest hour first.

    ``exact=False`` takes the percentile from a sketch of bounded size in a
    single shuffle; its rank is off by at most ``1 / accuracy`` of the group.
    """
    return _health(in_hours(curated), HOURLY, exact, accuracy).orderBy(F.desc("hour"), "request_path")


def endpoint_health(curated: DataFrame, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Q3 without the hour, busiest path first."""
    return _health(curated, ["request_path"], exact, accuracy).orderBy(F.desc("requests"), "request_path")


def suspected_bots(curated: DataFrame) -> DataFrame:
    """Q4: addresses over strict limits per day, busiest first.

    Requests without an address form a group of their own here.
    """
    daily = (
        _from_server(curated)
        .groupBy("dt", "ip")
        .agg(
            F.count("*").alias("requests"),
            F.countDistinct("session_id").alias("sessions"),
            F.avg("latency_ms").alias("avg_latency_ms"),
        )
    )
    requests = F.col("requests")
    repeated = (F.col("sessions") <= BOT_FEW_SESSIONS) & (requests > BOT_REPEATED)
    suspect = (requests > BOT_REQUESTS) | repeated | (F.col("avg_latency_ms") > BOT_LATENCY_MS)
    return daily.filter(suspect).orderBy(F.desc("requests"), "dt", "ip")
