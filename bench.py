"""Time the headline queries and the two batch jobs; print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the threads. Every
query is run once to warm up and then three times; its time is the median. Raw
and curated files are written beforehand. Metrics read the curated files, as
they would in use; the jobs include their writes.
"""

import json
import os
import statistics
import time
from pathlib import Path

from gatetally.operators import attribution, curate, funnel, interest, joins, logqueries, traffic
from gatetally.plans import jobs
from gatetally.session import local_session
from gatetally.sources import files
from workload import inputs, stages

REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    base = stages.curated_base(spark, sf_dir)
    layers = jobs.open_layer(spark, base, "curated", jobs.CURATED)
    clicks, catalog, campaigns, sales = (layers[n] for n in jobs.CURATED)
    raw = files.read_clickstream(spark, files.layer_path(base, "raw", "clickstream/*.jsonl"))

    frames = {
        "scan_jsonl": lambda: raw,
        "curate_clickstream": lambda: curate.curate_clickstream(raw, inputs.TENANT),
        "dedup_clickstream": lambda: curate.distinct_rows(raw),
        "funnel_daily": lambda: funnel.funnel_daily(clicks),
        "quality_checks": lambda: funnel.funnel_checks(funnel.funnel_daily(clicks, ordered=False)),
        "event_rank": lambda: interest.event_rank(clicks),
        "event_rank_top": lambda: interest.event_rank_top(interest.event_rank(clicks, ordered=False), 1000),
        "anomalies": lambda: traffic.anomalies(clicks),
        "endpoint_anomalies": lambda: traffic.endpoint_anomalies(clicks),
        "session_attribution": lambda: attribution.session_attribution(clicks),
        "q1_funnel_daily": lambda: logqueries.step_sessions(clicks),
        "q2_interest_revenue": lambda: logqueries.interest_and_revenue(clicks),
        "q3_endpoint_hourly": lambda: logqueries.endpoint_hourly(clicks),
        "q3_endpoint_hourly_sketched": lambda: logqueries.endpoint_hourly(clicks, exact=False),
        "q3_endpoint": lambda: logqueries.endpoint_health(clicks),
        "q4_suspected_bots": lambda: logqueries.suspected_bots(clicks),
        "clicks_with_catalog": lambda: joins.clicks_with_catalog(clicks, catalog),
        "tx_drop_orphans": lambda: joins.known_events(sales, catalog),
        "rank_with_catalog": lambda: joins.with_catalog(interest.event_rank(clicks, ordered=False), catalog),
        "campaign_roi": lambda: joins.campaign_roi(clicks, campaigns),
        "purchase_reconcile": lambda: joins.purchase_reconcile(clicks, sales),
    }

    def drained(build):
        return lambda: build().write.format("noop").mode("overwrite").save()

    work = {name: drained(build) for name, build in frames.items()}
    work["job_curate"] = lambda: jobs.curate_all(spark, base, inputs.TENANT).collect()
    work["job_analyse"] = lambda: jobs.analyse_all(spark, base).collect()

    seconds = {}
    for name, run in work.items():
        times = []
        for _ in range(REPEATS + 1):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
