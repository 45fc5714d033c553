"""Campaigns against the traffic of their own period.

A campaign runs from ``start_dt`` to ``end_dt``, both included; a missing or unreadable
one leaves that end open. Traffic is summed by campaign key and day first. Campaign
rows are dealt to the months that they touch, so that days meet the campaigns of their
key and month by an equi-join, and only then is the day compared with the period: a key
with many campaigns, or a campaign of many years, never meets all days of its key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatetally.functions.rounding import exact_sum, steady_round
from gatetally.operators.curate import client_events


def daily_earnings(curated: DataFrame) -> DataFrame:
    """Browser events, purchases and revenue per campaign key and day; days that are no date are left out."""
    bought = F.col("event_type") == "purchase"
    day = F.col("dt").try_cast("date")
    amount = F.when(bought, F.coalesce("amount", F.lit(0.0))).otherwise(0.0)
    return (
        client_events(curated)
        .withColumn("day", day)
        .filter(F.col("utm_campaign").isNotNull() & F.col("day").isNotNull())
        .groupBy("utm_campaign", "day")
        .agg(F.count("*").alias("events"), F.count_if(bought).alias("purchases"), exact_sum(amount).alias("revenue"))
    )


def _months(first: Column, last: Column) -> Column:
    """The first days of the months from ``first`` to ``last``."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def _share(first: Column, last: Column, month: Column) -> Column:
    """The part of a month's days that lie between two days."""
    end = F.last_day(month)
    return (F.date_diff(F.least(last, end), F.greatest(first, month)) + 1) / F.dayofmonth(end)


def campaign_periods(curated: DataFrame, campaigns: DataFrame, first: str, last: str) -> DataFrame:
    """Each campaign with what it cost and brought in between ``first`` and ``last`` (``YYYY-MM-DD``).

    Open ends are cut at those days, and campaigns that did not run in between are
    left out. ``cost`` is the monthly cost by the share of each month's days. Campaigns
    of one key may overlap; a day then counts for each of them. Copies of a campaign
    row are one campaign.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    start, end = F.col("start_dt").try_cast("date"), F.col("end_dt").try_cast("date")
    own = ["campaign_id", "utm_campaign", "channel", "active_from", "active_to", "cost"]
    running = (
        campaigns.select(
            "campaign_id",
            "utm_campaign",
            "channel",
            "monthly_cost",
            F.greatest(F.coalesce(start, low), low).alias("active_from"),
            F.least(F.coalesce(end, high), high).alias("active_to"),
        )
        .filter(F.col("active_from") <= F.col("active_to"))
        .distinct()
    )
    shares = F.transform(
        _months(F.col("active_from"), F.col("active_to")),
        lambda month: _share(F.col("active_from"), F.col("active_to"), month),
    )
    months = F.aggregate(shares, F.lit(0.0), lambda total, share: total + share)
    priced = running.withColumn("cost", steady_round(F.col("monthly_cost") * months, 2))
    by_month = priced.withColumn("month", F.explode(_months(F.col("active_from"), F.col("active_to"))))
    earned = daily_earnings(curated).withColumn("month", F.trunc("day", "month"))
    on_day = F.col("day").between(F.col("active_from"), F.col("active_to"))
    zero = F.lit(0).cast("bigint")
    return (
        by_month.join(earned, ["utm_campaign", "month"], "left")
        .groupBy(*own)
        .agg(
            F.sum(F.when(on_day, F.col("events")).otherwise(zero)).alias("events"),
            F.sum(F.when(on_day, F.col("purchases")).otherwise(zero)).alias("purchases"),
            steady_round(exact_sum(F.when(on_day, F.col("revenue")).otherwise(0.0)), 2).alias("revenue_total"),
        )
        .withColumns(
            {
                "net_revenue": steady_round(F.col("revenue_total") - F.col("cost"), 2),
                "revenue_per_cost": steady_round(F.try_divide("revenue_total", "cost"), 6),
            }
        )
    )
