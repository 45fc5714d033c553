"""One callable ``(spark, sf_dir) -> DataFrame`` per operator of the library.

Timestamps and dates are shown as text and unrounded averages to six places,
so that results can be compared with another engine's value by value.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.functions import cells as C
from gatetally.functions.rounding import steady_round
from gatetally.operators import attribution, curate, funnel, interest, joins, logqueries, periods, traffic
from gatetally.plans import jobs
from gatetally.session import stream_session, use_utc
from gatetally.sources import days, files, open_fields, relational
from gatetally.streaming import additive, digests, live, sinks, sketches, visits
from workload import inputs, stages
from workload.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def _shown(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({t: F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSS") for t in times})


def _six(df: DataFrame, *numbers: str) -> DataFrame:
    return df.withColumns({n: steady_round(F.col(n), 6) for n in numbers})


# Sources and sinks ---------------------------------------------------------


@query
def scan_jsonl(spark, sf_dir):
    path = files.layer_path(stages.raw_base(spark, sf_dir), "raw", "clickstream/*.jsonl")
    return files.read_clickstream(spark, path)


@query
def scan_csv(spark, sf_dir):
    path = files.layer_path(stages.raw_base(spark, sf_dir), "raw", "business/transactions.csv")
    return files.read_csv(spark, path, S.TX_RAW)


@query
def scan_partitioned(spark, sf_dir):
    path = files.layer_path(stages.curated_base(spark, sf_dir), "curated", "clickstream")
    stored = files.read_layer(spark, path, S.CLICK_CURATED)
    return stored.filter(F.col("event_type") == "purchase").select("dt", "session_id", "event_id", "amount")


@query
def partition_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "roundtrip")
    files.write_layer(stages.sales(spark, sf_dir), path, S.LAYER_KEYS["transactions"])
    return _shown(files.read_layer(spark, path, S.TX_CURATED), "tx_ts")


@query
def days_replaced(spark, sf_dir):
    """The anomaly metric stored by day, and its odd days replaced by that of failed requests alone."""
    path, keys = scratch_dir(spark, "days"), S.LAYER_KEYS["metrics_anomalies"]
    clicks = stages.clicks(spark, sf_dir)
    daily = traffic.anomalies(clicks, ordered=False)
    days.write_days(daily, path, keys)
    odd = F.substring("dt", 10, 1).isin("1", "3", "5", "7", "9")
    named = [r["dt"] for r in daily.filter(odd).select("dt").distinct().collect()]
    failed = traffic.anomalies(clicks.filter(odd & (F.col("status_code") >= 500)), ordered=False)
    days.write_days(failed, path, keys, named)
    return files.read_layer(spark, path, S.ANOMALY)


@query
def open_fields_curated(spark, sf_dir):
    """Fields outside the contract, in the rows that have a referrer."""
    path = scratch_dir(spark, "open-fields")
    stages.open_lines(spark, sf_dir).write.text(path)
    rows = curate.curate_clickstream(open_fields.read_open(spark, path), inputs.TENANT)
    return rows.select(
        "dt",
        "session_id",
        "event_type",
        F.to_json("extra").alias("extra"),
        F.try_variant_get("extra", "$.plan.tier", "int").alias("tier"),
        F.try_variant_get("extra", "$.score", "int").alias("score"),
    )


@query
def malformed_lines(spark, sf_dir):
    path = files.layer_path(stages.raw_base(spark, sf_dir), "raw", "clickstream/*.jsonl")
    return open_fields.malformed_lines(open_fields.read_open(spark, path)).select("malformed")


def _sunk(df: DataFrame, table: relational.Table) -> DataFrame:
    return relational.sink_frame(df, table).withColumn("dt", F.col("dt").cast("string"))


@query
def sink_types(spark, sf_dir):
    rank = interest.event_rank(stages.clicks(spark, sf_dir), ordered=False)
    exact = rank.withColumn("revenue_total", F.col("revenue_total").cast("decimal(18,2)"))
    return _sunk(exact, relational.RANK_TABLE)


@query
def sink_funnel(spark, sf_dir):
    return _sunk(funnel.funnel_daily(stages.clicks(spark, sf_dir), ordered=False), relational.FUNNEL_TABLE)


@query
def sink_anomalies(spark, sf_dir):
    flagged = traffic.flagged_rows(traffic.anomalies(stages.clicks(spark, sf_dir), ordered=False))
    return _sunk(flagged, relational.ANOMALY_TABLE)


@query
def metric_counts(spark, sf_dir):
    """Row counts of the stored metrics, after the second batch job."""
    return jobs.analyse_all(spark, stages.curated_base(spark, sf_dir))


@query
def layer_counts(spark, sf_dir):
    return funnel.layer_counts(jobs.open_layer(spark, stages.curated_base(spark, sf_dir), "curated", jobs.CURATED))


@query
def catalog_active(spark, sf_dir):
    path = scratch_dir(spark, "web-catalog")
    shown = curate.web_catalog(inputs.catalog(spark, sf_dir))
    files.write_json_lines(shown, path)
    return spark.read.schema(shown.schema).json(path)


@query
def retention(spark, sf_dir):
    """Day keys of two other forms are mixed in; some days lie after the last one kept."""
    clicks = stages.clicks(spark, sf_dir)
    odd = F.when(F.col("event_id") == 7, "10-04-2024").when(F.col("event_id") == 8, "2023/12/01")
    kept = curate.retained(clicks.withColumn("dt", F.coalesce(odd, "dt")), 14, "2024-01-25")
    return kept.select("dt", "session_id", "event_type", "source", "event_id", "ip")


# Projections, filters and casts --------------------------------------------


@query
def ensure_columns(spark, sf_dir):
    narrow = inputs.clickstream(spark, sf_dir).drop("element_id", "query", "amount", "referrer")
    return curate.with_missing(narrow, S.CLICK_RAW)


@query
def tenant_filter(spark, sf_dir):
    return curate.of_tenant(inputs.clickstream(spark, sf_dir), inputs.TENANT)


@query
def lenient_casts(spark, sf_dir):
    raw = inputs.clickstream(spark, sf_dir)
    return raw.select(
        C.whole_number(F.col("event_id")).alias("event_id"),
        C.whole_number(F.col("status_code"), "int").alias("status_code"),
        C.real_number(F.col("latency_ms")).alias("latency_ms"),
        C.real_number(F.col("amount")).alias("amount"),
    )


@query
def parse_ts(spark, sf_dir):
    raw = inputs.clickstream(spark, sf_dir)
    return _shown(raw.select("timestamp", C.instant(F.col("timestamp")).alias("event_ts")), "event_ts")


@query
def repair_dt(spark, sf_dir):
    raw = inputs.transactions(spark, sf_dir)
    day = C.settled_day(F.col("dt"), C.instant(F.col("timestamp")))
    return raw.select("transaction_id", "timestamp", F.col("dt").alias("given_dt"), day.alias("dt"))


@query
def catalog_dt(spark, sf_dir):
    raw = inputs.catalog(spark, sf_dir)
    return raw.select("event_date", C.or_unknown(C.day_text(F.col("event_date"))).alias("dt"))


@query
def default_labels(spark, sf_dir):
    raw = inputs.clickstream(spark, sf_dir)
    labels = [C.or_unknown(F.col(c)).alias(c) for c in ("event_type", "source")]
    return raw.select("session_id", "page", *labels)


@query
def non_blank(spark, sf_dir):
    raw = inputs.transactions(spark, sf_dir)
    return raw.filter(C.filled(F.col("transaction_id")) & C.filled(F.col("session_id"))).select(
        "transaction_id", "session_id"
    )


def _checked(df: DataFrame, label: str, cell: str, check) -> DataFrame:
    return df.select(F.lit(label).alias("field"), F.col(cell).alias("given"), check.alias("kept"))


@query
def range_checks(spark, sf_dir):
    price, cost, amount = (C.real_number(F.col(c)) for c in ("base_price", "monthly_cost", "amount"))
    return (
        _checked(inputs.catalog(spark, sf_dir), "price", "base_price", C.between_open(price, *S.PRICE_RANGE))
        .unionByName(_checked(inputs.campaigns(spark, sf_dir), "cost", "monthly_cost", C.from_up_to(cost, *S.COST_RANGE)))
        .unionByName(_checked(inputs.transactions(spark, sf_dir), "amount", "amount", C.between_open(amount, *S.AMOUNT_RANGE)))
    )


@query
def domain_checks(spark, sf_dir):
    channel, payment = C.one_of(F.col("channel"), S.CHANNELS), C.one_of(F.col("payment_method"), S.PAYMENT_METHODS)
    return _checked(inputs.campaigns(spark, sf_dir), "channel", "channel", channel).unionByName(
        _checked(inputs.transactions(spark, sf_dir), "payment", "payment_method", payment)
    )


@query
def curate_clickstream(spark, sf_dir):
    return _shown(stages.clicks(spark, sf_dir), "event_ts")


@query
def curate_catalog(spark, sf_dir):
    return stages.catalog(spark, sf_dir)


@query
def curate_campaigns(spark, sf_dir):
    return stages.campaigns(spark, sf_dir)


@query
def curate_transactions(spark, sf_dir):
    return _shown(stages.sales(spark, sf_dir), "tx_ts")


@query
def client_scope(spark, sf_dir):
    return curate.client_events(stages.clicks(spark, sf_dir)).select(
        "dt", "session_id", "event_type", "event_id", "utm_campaign", "amount"
    )


@query
def server_scope(spark, sf_dir):
    return curate.server_requests(stages.clicks(spark, sf_dir)).select(
        "dt", "ip", "session_id", "request_path", "method", "status_code", "latency_ms"
    )


@query
def ingest_defaults(spark, sf_dir):
    return curate.ingest_defaults(inputs.collected(spark, sf_dir), "t9")


@query
def client_ip(spark, sf_dir):
    rows = inputs.collected(spark, sf_dir)
    ip = C.first_forwarded(F.col("forwarded_for"), F.col("peer"))
    return rows.select("forwarded_for", "peer", ip.alias("client_ip"))


@query
def stamped_rows(spark, sf_dir):
    rows = inputs.clickstream(spark, sf_dir, keep=("ts",)).withColumnRenamed("e_ts", "ingest_ts")
    return curate.stamped(rows).select("timestamp", "dt", "source", "page", "ip")


# Joins ---------------------------------------------------------------------


@query
def tx_drop_orphans(spark, sf_dir):
    strict = joins.curate_transactions_strict(inputs.transactions(spark, sf_dir), stages.catalog(spark, sf_dir))
    return _shown(strict, "tx_ts")


@query
def tx_orphans(spark, sf_dir):
    lost = joins.orphan_sales(stages.sales(spark, sf_dir), stages.catalog(spark, sf_dir))
    return lost.select("transaction_id", "dt", "session_id", "event_id", "amount")


@query
def rank_with_catalog(spark, sf_dir):
    rank = interest.event_rank(stages.clicks(spark, sf_dir), ordered=False)
    return joins.with_catalog(rank, stages.catalog(spark, sf_dir))


@query
def clicks_with_catalog(spark, sf_dir):
    told = joins.clicks_with_catalog(stages.clicks(spark, sf_dir), stages.catalog(spark, sf_dir))
    return told.select("dt", "session_id", "event_type", "event_id", "amount", *joins.SHOWN)


@query
def campaign_roi(spark, sf_dir):
    return joins.campaign_roi(stages.clicks(spark, sf_dir), stages.campaigns(spark, sf_dir))


@query
def campaign_periods(spark, sf_dir):
    """Campaigns of one key overlap; some have an open or unreadable end."""
    number = F.col("campaign_id").cast("int")
    start = F.when(number % 4 != 0, F.date_add(F.lit("2024-01-01").cast("date"), number % 20).cast("string"))
    end = F.when(number % 5 == 0, None).when(number % 6 == 0, "later")
    end = end.otherwise(F.date_add(F.lit("2024-01-10").cast("date"), number % 30).cast("string"))
    planned = stages.campaigns(spark, sf_dir).withColumns({"start_dt": start, "end_dt": end})
    found = periods.campaign_periods(stages.clicks(spark, sf_dir), planned, "2024-01-03", "2024-02-15")
    return found.withColumns({c: F.col(c).cast("string") for c in ("active_from", "active_to")})


@query
def purchase_reconcile(spark, sf_dir):
    return joins.purchase_reconcile(stages.clicks(spark, sf_dir), stages.sales(spark, sf_dir))


# Metrics -------------------------------------------------------------------


@query
def session_flags(spark, sf_dir):
    return funnel.session_flags(stages.clicks(spark, sf_dir))


@query
def funnel_daily(spark, sf_dir):
    return funnel.funnel_daily(stages.clicks(spark, sf_dir))


@query
def detail_views(spark, sf_dir):
    return interest.detail_views(stages.clicks(spark, sf_dir))


@query
def event_purchases(spark, sf_dir):
    return interest.event_purchases(stages.clicks(spark, sf_dir))


@query
def event_rank(spark, sf_dir):
    return interest.event_rank(stages.clicks(spark, sf_dir))


@query
def event_rank_joined(spark, sf_dir):
    clicks = stages.clicks(spark, sf_dir)
    return interest.join_interest(interest.detail_views(clicks), interest.event_purchases(clicks))


@query
def event_rank_top(spark, sf_dir):
    return interest.event_rank_top(interest.event_rank(stages.clicks(spark, sf_dir), ordered=False), 1000)


@query
def ip_traffic(spark, sf_dir):
    return traffic.daily_traffic(stages.clicks(spark, sf_dir))


@query
def anomalies(spark, sf_dir):
    return traffic.anomalies(stages.clicks(spark, sf_dir))


@query
def anomalies_flagged(spark, sf_dir):
    return traffic.anomalies_flagged(traffic.anomalies(stages.clicks(spark, sf_dir), ordered=False), 1000)


@query
def endpoint_anomalies(spark, sf_dir):
    return traffic.endpoint_anomalies(stages.clicks(spark, sf_dir))


@query
def quality_checks(spark, sf_dir):
    return funnel.funnel_checks(funnel.funnel_daily(stages.clicks(spark, sf_dir), ordered=False))


@query
def dedup_clickstream(spark, sf_dir):
    return curate.distinct_rows(inputs.clickstream_with_copies(spark, sf_dir))


@query
def curate_clickstream_strict(spark, sf_dir):
    raw = inputs.clickstream_with_copies(spark, sf_dir)
    return _shown(curate.curate_clickstream_strict(raw, inputs.TENANT), "event_ts")


@query
def session_attribution(spark, sf_dir):
    told = attribution.session_attribution(stages.clicks(spark, sf_dir)).select(
        "session_id", "event_ts", "event_type", "event_id", "attr_campaign", "attr_referrer", "first_seen_ts"
    )
    return _shown(told, "event_ts", "first_seen_ts")


# Log queries ---------------------------------------------------------------


@query
def q1_funnel_daily(spark, sf_dir):
    return logqueries.step_sessions(stages.clicks(spark, sf_dir))


@query
def q2_interest_revenue(spark, sf_dir):
    return _six(logqueries.interest_and_revenue(stages.clicks(spark, sf_dir)), "revenue_total")


@query
def q3_endpoint_hourly(spark, sf_dir):
    return _shown(_six(logqueries.endpoint_hourly(stages.clicks(spark, sf_dir)), "avg_latency_ms"), "hour")


@query
def q3_endpoint(spark, sf_dir):
    return _six(logqueries.endpoint_health(stages.clicks(spark, sf_dir)), "avg_latency_ms")


@query
def q4_suspected_bots(spark, sf_dir):
    return _six(logqueries.suspected_bots(stages.clicks(spark, sf_dir)), "avg_latency_ms")


# Streams, run over all files there are -------------------------------------


def _drained(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(spark, label)
    sinks.append_files(df, path, scratch_dir(spark, f"{label}-checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query
def stream_curation(spark, sf_dir):
    return _shown(_drained(spark, stages.click_stream(spark, sf_dir), "stream-curated"), "event_ts")


@query
def stream_endpoint_hourly(spark, sf_dir):
    hours = live.endpoint_hourly_stream(stages.click_stream(spark, sf_dir))
    return _shown(_six(_drained(spark, hours, "stream-hours"), "avg_latency_ms"), "hour")


@query
def stream_endpoint_hourly_stored(spark, sf_dir):
    """Over several batches; late and untimed rows and the last hour count as in batch."""
    path = scratch_dir(spark, "stream-endpoints")
    stream = stages.click_stream(spark, sf_dir, batches=3)
    additive.store_endpoint_counts(stream, path, scratch_dir(spark, "stream-endpoints-checkpoint")).awaitTermination()
    return _shown(_six(additive.endpoint_hourly(spark, path), "avg_latency_ms"), "hour")


@query
def stream_ip_anomalies_closed(spark, sf_dir):
    return _drained(spark, live.ip_anomalies_closed(stages.click_stream(spark, sf_dir)), "stream-days")


@query
def stream_ip_anomalies(spark, sf_dir):
    """Over several batches; late and untimed rows count as in batch."""
    path = scratch_dir(spark, "stream-live")
    stream = stages.click_stream(spark, sf_dir, batches=3)
    additive.store_session_sums(stream, path, scratch_dir(spark, "stream-live-checkpoint")).awaitTermination()
    return additive.ip_anomalies(spark, path)


@query
def stream_metric_upsert(spark, sf_dir):
    """Stored twice into one table, in batches of other sizes: the second run replaces the first."""
    path = scratch_dir(spark, "stream-rerun")
    for run, batches in enumerate((3, 1)):
        stream = stages.click_stream(spark, sf_dir, batches=batches)
        checkpoint = scratch_dir(spark, f"stream-rerun-{run}")
        additive.store_session_sums(stream, path, checkpoint, run).awaitTermination()
    return additive.ip_anomalies(spark, path)


@query
def stream_ip_anomalies_sketched(spark, sf_dir):
    days = live.ip_anomalies_sketched(stages.click_stream(spark, sf_dir))
    path = scratch_dir(spark, "stream-sketch")
    sinks.upsert_metrics(days, path, scratch_dir(spark, "stream-sketch-checkpoint")).awaitTermination()
    return sinks.latest_metrics(spark, path, days.schema, ["dt", "ip"])


@query
def stream_tail(spark, sf_dir):
    """Lines of files followed by position, in two runs; files come between them."""
    path, out, state = (scratch_dir(spark, f"stream-tail{x}") for x in ("", "-out", "-checkpoint"))
    lines = stages.json_lines(spark, sf_dir)
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for part in (lines.filter(first), lines.filter(~first)):
        part.write.mode("append").text(path)
        rows = files.tail_clickstream(stream_session(spark), path, split_bytes=1 << 18)
        sinks.append_files(rows, out, state).awaitTermination()
    return spark.read.schema(S.CLICK_RAW).parquet(out)


@query
def stream_attribution(spark, sf_dir):
    """Events in any order over several batches; later ones correct earlier ones."""
    path = scratch_dir(spark, "stream-visits")
    stream = stages.click_stream(spark, sf_dir, batches=3)
    visits.store_attribution(stream, path, scratch_dir(spark, "stream-visits-checkpoint"), "400 days").awaitTermination()
    raw = files.layer_path(stages.raw_base(spark, sf_dir), "raw", "clickstream/*.jsonl")
    curated = curate.curate_clickstream(files.read_clickstream(spark, raw), inputs.TENANT)
    told = visits.attributed(spark, path, curated).select(
        "session_id", "event_ts", "event_type", "event_id", "attr_campaign", "attr_referrer", "first_seen_ts"
    )
    return _shown(told, "event_ts", "first_seen_ts")


@query
def stream_endpoint_percentiles(spark, sf_dir):
    """Sketches of several batches and all hours merged by path; ``p95_near`` tells that the rank is right."""
    path = scratch_dir(spark, "stream-sketches")
    stream = stages.click_stream(spark, sf_dir, batches=4)
    sketches.store_endpoint_sketches(stream, path, scratch_dir(spark, "stream-sketches-checkpoint")).awaitTermination()
    health = sketches.endpoint_percentiles(spark, path, (95,))
    timed = stages.clicks(spark, sf_dir).filter("event_type = 'server_request' AND latency_ms IS NOT NULL")
    joined = timed.join(health.select("request_path", "p95_latency_ms"), "request_path")
    share = F.count_if(F.col("latency_ms") <= F.col("p95_latency_ms")) / F.count("*")
    below = F.count_if(F.col("latency_ms") < F.col("p95_latency_ms")) / F.count("*")
    error = 2.6 / sketches.K
    ranks = joined.groupBy("request_path").agg(((below <= 0.95 + error) & (share >= 0.95 - error)).alias("p95_near"))
    return _six(health.join(ranks, "request_path").drop("p95_latency_ms"), "avg_latency_ms")


@query
def stream_dedup(spark, sf_dir):
    """Copies in different batches, with and without a time."""
    path = scratch_dir(spark, "stream-distinct")
    stream = stages.copies_stream(spark, sf_dir, batches=3)
    digests.store_distinct_rows(stream, path, scratch_dir(spark, "stream-distinct-checkpoint")).awaitTermination()
    return _shown(curate.curate_clickstream(digests.distinct_rows(spark, path), inputs.TENANT), "event_ts")
