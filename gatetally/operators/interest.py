"""Interest in an event against what it sold."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatetally.functions.rounding import exact_sum, steady_round
from gatetally.operators.curate import client_events

KEYS = ["dt", "event_id"]
VIEW, SALE = "view_event_detail", "purchase"


def _revenue(amount: Column) -> Column:
    return steady_round(exact_sum(F.coalesce(amount, F.lit(0.0))), 2)


def _about_events(curated: DataFrame, *kinds: str) -> DataFrame:
    return client_events(curated).filter(F.col("event_type").isin(*kinds) & F.col("event_id").isNotNull())


def detail_views(curated: DataFrame) -> DataFrame:
    return _about_events(curated, VIEW).groupBy(KEYS).agg(F.count("*").alias("detail_views"))


def event_purchases(curated: DataFrame) -> DataFrame:
    return (
        _about_events(curated, SALE)
        .groupBy(KEYS)
        .agg(F.count("*").alias("purchases"), _revenue(F.col("amount")).alias("revenue_total"))
    )


def _with_ratio(counts: DataFrame) -> DataFrame:
    """Views per purchase; the bare number of views where nothing was bought."""
    views, bought = F.col("detail_views"), F.col("purchases")
    ratio = F.round(views / F.greatest(bought, F.lit(1)), 6)
    return counts.select(*KEYS, views, bought, "revenue_total", ratio.alias("interest_to_purchase_ratio"))


def rank_order() -> list[Column]:
    """By day, most interest per purchase first; the event breaks ties."""
    return [F.col("dt"), F.col("interest_to_purchase_ratio").desc(), F.col("event_id")]


def event_rank(curated: DataFrame, ordered: bool = True) -> DataFrame:
    """Views, purchases, revenue and their ratio per day and event.

    Both counts come from one pass and one shuffle: an event with views only or
    purchases only is in the group just the same, so no join is needed.
    """
    is_view, is_sale = F.col("event_type") == VIEW, F.col("event_type") == SALE
    counts = (
        _about_events(curated, VIEW, SALE)
        .groupBy(KEYS)
        .agg(
            F.count_if(is_view).alias("detail_views"),
            F.count_if(is_sale).alias("purchases"),
            _revenue(F.when(is_sale, F.col("amount"))).alias("revenue_total"),
        )
    )
    ranked = _with_ratio(counts)
    return ranked.orderBy(*rank_order()) if ordered else ranked


def join_interest(views: DataFrame, purchases: DataFrame) -> DataFrame:
    """The same table from stored view and purchase counts: a full outer join
    on day and event, with zeros on the side that is missing."""
    both = views.join(purchases, KEYS, "full")
    return _with_ratio(both.fillna({"detail_views": 0, "purchases": 0, "revenue_total": 0.0}))


def event_rank_top(rank: DataFrame, n: int) -> DataFrame:
    """A report of the first ``n`` rows in rank order, so the earliest days come first."""
    return rank.orderBy(*rank_order()).limit(n)
