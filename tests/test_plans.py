"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from gatetally.operators import attribution, curate, funnel, interest, joins, logqueries, traffic
from gatetally.plans import jobs
from workload import stages
from workload.queries import REGISTRY


@pytest.fixture(scope="module")
def layers(spark, sf_dir):
    return jobs.open_layer(spark, stages.curated_base(spark, sf_dir), "curated", jobs.CURATED)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range)partitioning|Exchange SinglePartition", plan_of(df)))


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if not n.startswith("stream_")))
def test_no_python_no_product_no_single_task(spark, sf_dir, name):
    plan = plan_of(REGISTRY[name](spark, sf_dir))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    if "SinglePartition" in plan:  # only global counts, one row per task
        assert name in ("layer_counts", "metric_counts", "quality_checks")


def test_curation_needs_no_shuffle(spark, sf_dir):
    for df in (stages.clicks, stages.sales, stages.catalog, stages.campaigns):
        assert shuffles(df(spark, sf_dir)) == 0


def test_shuffle_counts(layers):
    clicks = layers["clickstream"]
    assert shuffles(funnel.funnel_daily(clicks, ordered=False)) == 2
    assert shuffles(interest.event_rank(clicks, ordered=False)) == 1
    assert shuffles(traffic.anomalies(clicks, ordered=False)) == 2
    assert shuffles(logqueries.endpoint_health(clicks, exact=False)) == 2
    assert shuffles(curate.distinct_rows(clicks)) == 1


def test_hot_keys_are_spread_before_the_distinct_count(layers):
    plan = plan_of(traffic.daily_traffic(layers["clickstream"]))
    assert re.search(r"hashpartitioning\(dt#\d+, ip#\d+, session_id#\d+", plan)


def test_attribution_is_partitioned_by_slices(layers):
    plan = plan_of(attribution.session_attribution(layers["clickstream"]))
    assert re.search(r"hashpartitioning\(session_id#\d+, _slice#\d+", plan)


def test_filters_and_columns_reach_the_scan(layers):
    plan = plan_of(interest.event_purchases(layers["clickstream"]))
    assert re.search(r"PartitionFilters: \[[^\]]*event_type#\d+ = purchase", plan)
    assert "EqualTo(source,client)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"session_id", "source", "event_id", "amount"}


def test_retention_prunes_folders(layers):
    plan = plan_of(curate.retained(layers["clickstream"], 14, "2024-01-31"))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 2024-01-17", plan)


def test_exact_percentile_scans_once(layers):
    df = logqueries.endpoint_hourly(layers["clickstream"])
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


def test_top_rows_need_no_full_sort(layers):
    plan = plan_of(interest.event_rank_top(interest.event_rank(layers["clickstream"], ordered=False), 1000))
    assert "TakeOrderedAndProject" in plan


def test_a_large_dimension_is_not_broadcast(spark, layers):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "1")
    try:
        for df in (
            joins.known_events(layers["transactions"], layers["events"]),
            joins.campaign_roi(layers["clickstream"], layers["campaigns"]),
            attribution.session_attribution(layers["clickstream"]),
        ):
            assert "BroadcastHashJoin" not in plan_of(df)
            df.collect()
    finally:
        spark.conf.set(limit, usual)


def test_rows_about_no_event_are_spread(spark, layers):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        df = joins.clicks_with_catalog(layers["clickstream"], layers["events"])
        assert re.search(r"hashpartitioning\(event_id#\d+L, _spread#\d+L", plan_of(df))
        assert df.count() == layers["clickstream"].count()
        assert df.filter("name is not null").count() > 0
    finally:
        spark.conf.set(limit, usual)


@pytest.mark.parametrize(
    "name", ["anomalies", "q2_interest_revenue", "q3_endpoint_hourly", "q3_endpoint", "q4_suspected_bots"]
)
def test_sorts_are_by_unique_keys(spark, sf_dir, name):
    """A sort with many ties would put them all in one task."""
    df = REGISTRY[name](spark, sf_dir)
    by = re.search(r"rangepartitioning\((.*?), \d+\)", plan_of(df)).group(1)
    keys = re.findall(r"(\w+)#\d+L? (?:ASC|DESC)", by)
    assert df.groupBy(*keys).count().filter("count > 1").count() == 0


def test_a_hot_event_is_split_over_tasks(spark):
    """Two thirds of the sales are of one event, and the catalog is too large to broadcast."""
    event = F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 1000)
    sales = spark.range(0, 300000, numPartitions=8).select(event.alias("event_id"), F.sha2(F.col("id").cast("string"), 256))
    catalog = spark.range(0, 2000).select((F.col("id") % 500).alias("event_id"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    usual = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        for join in (joins.known_events, joins.orphan_sales):
            df = join(sales, catalog)
            df.collect()
            assert "skew=true" in plan_of(df)
        known, lost = joins.known_events(sales, catalog).count(), joins.orphan_sales(sales, catalog).count()
        assert known + lost == 300000
    finally:
        for k, v in usual.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
