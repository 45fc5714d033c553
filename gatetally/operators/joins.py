"""Joins between sales, catalog, campaigns and clickstream.

Facts are aggregated to the join key before they are joined, and dimensions are
brought to one row per key, so no join multiplies rows and a key holding a third
of the facts arrives as one row per task. No side is forced to broadcast: the
optimizer does that at run time for sides it has measured to be small, and
splits skewed partitions otherwise.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatetally.functions.rounding import exact_sum, steady_round
from gatetally.operators.curate import client_events, curate_transactions

# Catalog columns shown beside an event.
SHOWN = ["name", "city", "category", "base_price"]


def known_events(transactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sales whose event is in the curated catalog."""
    return transactions.join(catalog.select("event_id"), "event_id", "left_semi").select(transactions.columns)


def orphan_sales(transactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sales whose event is missing from the curated catalog."""
    return transactions.join(catalog.select("event_id"), "event_id", "left_anti").select(transactions.columns)


def curate_transactions_strict(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Curation with the documented removal of sales of unknown events."""
    return known_events(curate_transactions(raw), catalog)


def one_per_event(catalog: DataFrame) -> DataFrame:
    """One row per event: the smallest in name, city, category and price."""
    return (
        catalog.groupBy("event_id")
        .agg(F.min(F.struct(*SHOWN)).alias("shown"))
        .select("event_id", *[F.col(f"shown.{c}").alias(c) for c in SHOWN])
    )


def with_catalog(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows with their event's name, city, category and price, where known."""
    return df.join(one_per_event(catalog), "event_id", "left").select(*df.columns, *SHOWN)


def clicks_with_catalog(curated: DataFrame, catalog: DataFrame) -> DataFrame:
    """Clickstream rows with their event's catalog entry, where there is one.

    Most rows are about no event, and null keys would all meet in one task. A
    second key spreads them by content; it is 0 wherever there is an event, on
    both sides, so it changes no match.
    """
    no_event = F.col("event_id").isNull()
    by_content = 1 + F.pmod(F.xxhash64("session_id", "ip", "timestamp", "page"), F.lit(4096))
    left = curated.withColumn("_spread", F.when(no_event, by_content).otherwise(0))
    right = one_per_event(catalog).withColumn("_spread", F.when(no_event, F.lit(1)).otherwise(0).cast("bigint"))
    return left.join(right, ["event_id", "_spread"], "left").select(*curated.columns, *SHOWN)


def campaign_cost(campaigns: DataFrame) -> DataFrame:
    """One row per campaign key with the summed monthly cost."""
    return campaigns.groupBy("utm_campaign").agg(steady_round(exact_sum(F.col("monthly_cost")), 2).alias("monthly_cost"))


def campaign_roi(curated: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Browser events, purchases and revenue per campaign against its cost.

    A full outer join: campaigns of the clickstream that are not among the
    curated ones have a null cost, campaigns without traffic have zeros.
    ``revenue_per_cost`` is null without a cost. The cost is that of one month and
    the events are those given: pass the rows of a month for its return.
    """
    bought = F.col("event_type") == "purchase"
    earned = (
        client_events(curated)
        .filter(F.col("utm_campaign").isNotNull())
        .groupBy("utm_campaign")
        .agg(
            F.count("*").alias("events"),
            F.count_if(bought).alias("purchases"),
            steady_round(exact_sum(F.when(bought, F.coalesce("amount", F.lit(0.0))).otherwise(0.0)), 2).alias(
                "revenue_total"
            ),
        )
    )
    joined = earned.join(campaign_cost(campaigns), "utm_campaign", "full").fillna(
        {"events": 0, "purchases": 0, "revenue_total": 0.0}
    )
    return joined.select(
        "*",
        steady_round(F.col("revenue_total") - F.col("monthly_cost"), 2).alias("net_revenue"),
        steady_round(F.try_divide("revenue_total", "monthly_cost"), 6).alias("revenue_per_cost"),
    )


def purchase_reconcile(curated: DataFrame, transactions: DataFrame) -> DataFrame:
    """Purchases seen in the browser against booked sales, per session and event.

    A full outer join of the two aggregated sides: nothing is dropped, and
    ``status`` tells which side a row was found on, or else whether counts and
    amounts agree; ``amount_difference`` is browser less booked.
    """
    keys = ["session_id", "event_id"]
    clicks = (
        client_events(curated)
        .filter((F.col("event_type") == "purchase") & F.col("event_id").isNotNull())
        .groupBy(keys)
        .agg(
            F.count("*").alias("click_purchases"),
            steady_round(exact_sum(F.coalesce("amount", F.lit(0.0))), 2).alias("click_amount"),
        )
    )
    booked = transactions.groupBy(keys).agg(
        F.count("*").alias("tx_count"), steady_round(exact_sum(F.col("amount")), 2).alias("tx_amount")
    )
    difference = steady_round(F.col("click_amount") - F.col("tx_amount"), 2)
    status = (
        F.when(F.col("tx_count") == 0, "click_only")
        .when(F.col("click_purchases") == 0, "tx_only")
        .when(F.col("click_purchases") != F.col("tx_count"), "count_differs")
        .when(difference != 0, "amount_differs")
        .otherwise("matched")
    )
    zeros = {"click_purchases": 0, "click_amount": 0.0, "tx_count": 0, "tx_amount": 0.0}
    return clicks.join(booked, keys, "full").fillna(zeros).withColumns({"amount_difference": difference, "status": status})
