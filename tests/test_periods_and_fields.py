"""Campaign periods, open fields, merged percentiles, counts while writing, staged tables."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.operators import curate, funnel, logqueries, periods
from gatetally.plans import jobs
from gatetally.sources import files, open_fields, relational
from gatetally.streaming import runs, sketches

# Campaign periods


def campaign(number, key, start, end, cost=310.0):
    names = S.CAMPAIGN_CURATED.fieldNames()
    row = {"campaign_id": number, "utm_campaign": key, "channel": "email", "monthly_cost": cost, "dt": "unknown"}
    return tuple((row | {"start_dt": start, "end_dt": end}).get(n) for n in names)


def test_overlapping_campaigns_and_open_ends(spark, clicks):
    def visit(dt, key, **more):
        return {"dt": dt, "source": "client", "session_id": "s", "event_type": "click", "utm_campaign": key} | more

    rows = clicks(
        *[visit(f"2024-01-{d:02d}", "a") for d in range(1, 32)],
        visit("2024-01-10", "a", event_type="purchase", amount=12.5),
        visit("2024-02-29", "a", event_type="purchase", amount=None),
        visit("no day", "a"),
        visit("2024-01-05", None),
        visit("2024-01-05", "b"),
    )
    frame = spark.createDataFrame(
        [
            campaign("1", "a", "2024-01-10", "2024-01-19"),
            campaign("2", "a", "2024-01-15", None),
            campaign("3", "a", None, "2024-01-02"),
            campaign("3", "a", None, "2024-01-02"),
            campaign("4", "c", "soon", "later"),
            campaign("5", "a", "2024-03-01", None),
            campaign("6", "a", "2024-01-20", "2024-01-10"),
        ],
        S.CAMPAIGN_CURATED,
    )
    found = periods.campaign_periods(rows, frame, "2024-01-01", "2024-02-29")
    got = {r["campaign_id"]: (r["events"], r["purchases"], r["revenue_total"], r["cost"]) for r in found.collect()}
    assert got == {
        "1": (11, 1, 12.5, 100.0),
        "2": (18, 1, 0.0, 170.0 + 310.0),
        "3": (2, 0, 0.0, 20.0),
        "4": (0, 0, 0.0, 620.0),
    }
    assert periods.campaign_periods(clicks(), frame, "2024-01-01", "2024-01-31").count() == 4
    assert "CartesianProduct" not in (plan := found._jdf.queryExecution().toString()) and "NestedLoop" not in plan


# Open fields

LINES = [
    {"student_id": "t1", "timestamp": "2024-01-01T00:00:00Z", "session_id": "a", "plan": {"tier": 2, "tags": ["x", None]}, "score": 1.5},
    {"student_id": "t1", "timestamp": "2024-01-01T00:00:01Z", "session_id": "b", "amount": 5},
    {"student_id": "t2", "session_id": "c", "note": "é"},
]


@pytest.fixture
def lake(tmp_path):
    folder = tmp_path / "raw" / "clickstream"
    folder.mkdir(parents=True)
    text = "\n".join([*map(json.dumps, LINES), '{"student_id": "t1", "page": "cut', "", "no json"])
    (folder / "a.jsonl").write_text(text)
    business = tmp_path / "raw" / "business"
    business.mkdir()
    for name, schema in (("events", S.CATALOG_RAW), ("campaigns", S.CAMPAIGN_RAW), ("transactions", S.TX_RAW)):
        (business / f"{name}.csv").write_text(",".join(schema.fieldNames()) + "\n")
    return tmp_path


def test_fields_outside_the_contract_reach_the_curated_layer(spark, lake):
    base = str(lake)
    jobs.curate_all(spark, base, "t1", open_fields=True)
    stored = files.read_layer(spark, f"{base}/curated/clickstream", open_fields.CLICK_OPEN)
    got = {r["session_id"]: r["extra"] for r in stored.select("session_id", F.to_json("extra").alias("extra")).collect()}
    assert json.loads(got["a"]) == {"plan": {"tier": 2, "tags": ["x", None]}, "score": 1.5} and got["b"] is None
    tier = stored.select(F.try_variant_get("extra", "$.plan.tier", "int").alias("tier"), F.try_variant_get("extra", "$.score", "double"))
    assert (2, 1.5) in [tuple(r) for r in tier.collect()]
    lost = spark.read.json(f"{base}/curated/malformed").collect()
    assert sorted(r["malformed"] for r in lost) == ["no json", '{"student_id": "t1", "page": "cut']
    assert all(r["file"].endswith("a.jsonl") for r in lost)


def test_contract_columns_do_not_depend_on_open_fields(spark, lake):
    path = str(lake / "raw" / "clickstream" / "*.jsonl")
    plain = curate.curate_clickstream(files.read_clickstream(spark, path), "t1")
    opened = curate.curate_clickstream(open_fields.read_open(spark, path), "t1").select(plain.columns)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, opened.collect())) != []
    strict = curate.curate_clickstream_strict(open_fields.read_open(spark, path), "t1")
    assert strict.count() == 2 and open_fields.EXTRA in strict.columns


def test_open_fields_of_a_stream(spark, lake, tmp_path):
    rows = open_fields.stream_open(spark, str(lake / "raw" / "clickstream"))
    out = str(tmp_path / "out")
    writer = curate.curate_clickstream(rows, "t1").drop("malformed").writeStream.format("parquet")
    writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(out).awaitTermination()
    stored = spark.read.schema(open_fields.CLICK_OPEN).parquet(out)
    assert stored.filter(F.try_variant_get("extra", "$.plan.tier", "int") == 2).count() == 1 and stored.count() == 2


# Merged percentiles


def test_percentiles_after_many_merges_keep_their_rank(spark, tmp_path):
    path, total, merges = str(tmp_path / "s"), 24_000, 12
    values = spark.range(total).select(
        F.lit("server_request").alias("event_type"),
        F.lit("/").alias("request_path"),
        F.expr("timestamp_seconds(1704067200 + id % 36000)").alias("event_ts"),
        F.expr("pow(abs(hash(id)) % 100003, 1.7)").alias("latency_ms"),
        F.expr("cast(200 + id % 3 as int)").alias("status_code"),
        "id",
    ).persist()
    for batch in range(merges):
        runs.store_rows(sketches.endpoint_sketches(values.filter(F.col("id") % merges == batch)), path, 0, batch)
        runs.commit_batch(spark, path, sketches.ENDPOINT_SKETCHES, 0, batch, F.sum("n"))
    (row,) = sketches.endpoint_percentiles(spark, path).collect()
    assert row["requests"] == total and row["max_status"] == 202
    ordered = sorted(r[0] for r in values.select("latency_ms").collect())
    for percent in (50, 95, 99):
        rank = sum(v <= row[f"p{percent}_latency_ms"] for v in ordered) / total
        assert abs(rank - percent / 100) <= 2.6 / sketches.K
    (part,) = sketches.endpoint_percentiles(spark, path, (95,), datetime(2024, 1, 1, 2), datetime(2024, 1, 1, 5)).collect()
    inside = sorted(r[0] for r in values.filter("hour(event_ts) BETWEEN 2 AND 4").select("latency_ms").collect())
    assert part["requests"] == len(inside)
    assert abs(sum(v <= part["p95_latency_ms"] for v in inside) / len(inside) - 0.95) <= 2.6 / sketches.K


def test_merged_batches_and_requests_without_a_latency(spark, clicks, tmp_path):
    path = str(tmp_path / "s")
    at = datetime(2024, 1, 1, 7)
    rows = [
        {"event_type": "server_request", "request_path": "/", "event_ts": at, "latency_ms": x, "status_code": 200}
        for x in (1.0, 2.0, 3.0, float("nan"), None)
    ] + [{"event_type": "server_request", "request_path": "/x", "event_ts": None, "latency_ms": None}]
    for batch, some in enumerate((rows[:2], rows[2:])):
        runs.store_rows(sketches.endpoint_sketches(clicks(*some)), path, 0, batch)
        runs.commit_batch(spark, path, sketches.ENDPOINT_SKETCHES, 0, batch, F.sum("n"))
    def shown():
        found = sketches.endpoint_percentiles(spark, path, (50,), keys=("hour", "request_path")).collect()
        return {r["request_path"]: (r["hour"], r["requests"], r["avg_latency_ms"], r["p50_latency_ms"]) for r in found}

    want = {"/": (at, 5, 2.0, 2.0), "/x": (None, 1, None, None)}
    assert shown() == want
    runs.merge_batches(spark, path, sketches.ENDPOINT_SKETCHES, sketches.merged_sketches)
    assert shown() == want


def test_revenue_does_not_depend_on_the_number_of_partitions(spark, clicks):
    rng = random.Random(1)
    rows = [
        {"dt": "2024-01-01", "source": "client", "event_type": "purchase", "event_id": n % 3, "amount": rng.random() * 10 ** rng.randint(0, 6)}
        for n in range(500)
    ]
    df = clicks(*rows)
    results = {str(sorted(map(tuple, logqueries.interest_and_revenue(df.repartition(n)).collect()))) for n in (3, 7, 13)}
    assert len(results) == 1


# Counts while writing


def test_counts_are_taken_while_writing(spark, lake):
    base = str(lake)
    told = jobs.curate_all(spark, base, "t1")
    read = funnel.layer_counts(jobs.open_layer(spark, base, "curated", jobs.CURATED))
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, read.collect()))
    assert "FileScan" not in told._jdf.queryExecution().toString()
    told = jobs.analyse_all(spark, base)
    read = funnel.layer_counts(jobs.open_layer(spark, base, "analytics", jobs.ANALYTICS))
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, read.collect()))


# A table with its key


def anomaly(dt, ip):
    return (dt, ip, 1, 0, 0, 1, 1.0, 1.0, True, "r")


@pytest.mark.parametrize(
    "dialect, renames",
    [
        ("mysql", ["RENAME TABLE metrics_anomalies TO metrics_anomalies_old, metrics_anomalies_next TO metrics_anomalies"]),
        (
            "postgresql",
            [
                "BEGIN",
                "ALTER TABLE metrics_anomalies RENAME TO metrics_anomalies_old",
                "ALTER TABLE metrics_anomalies_next RENAME TO metrics_anomalies",
                "COMMIT",
            ],
        ),
    ],
)
def test_a_table_is_filled_beside_the_old_one_and_then_renamed(spark, dialect, renames):
    table, steps = relational.ANOMALY_TABLE, []
    df = spark.createDataFrame([anomaly("2024-01-01", "a"), anomaly("10/04/2024", "b"), anomaly("2024-01-01", None)], S.ANOMALY)

    def fill(rows, target):
        steps.append((target.name, sorted(map(str, (r["dt"] for r in rows.collect())))))

    lost = relational.replace_table(df, f"jdbc:{dialect}://h/db", table, {}, steps.extend, fill)
    staging = "metrics_anomalies_next"
    assert steps[0] == f"DROP TABLE IF EXISTS {staging}"
    assert steps[1] == table.staged().ddl() and "PRIMARY KEY (dt, ip)" in steps[1] and staging in steps[1]
    assert steps[2].startswith("CREATE TABLE IF NOT EXISTS metrics_anomalies (")
    filled = steps.index((staging, ["2024-01-01"]))
    assert steps[filled + 1 :] == [*renames, "DROP TABLE metrics_anomalies_old"]
    assert sorted(str(r["ip"]) for r in lost.collect()) == ["None", "b"]


def test_nothing_is_renamed_if_filling_fails(spark):
    steps = []

    def fill(rows, target):
        raise RuntimeError("duplicate key")

    df = spark.createDataFrame([anomaly("2024-01-01", "a")], S.ANOMALY)
    with pytest.raises(RuntimeError, match="duplicate"):
        relational.replace_table(df, "jdbc:mysql://h/db", relational.ANOMALY_TABLE, {}, steps.extend, fill)
    assert not any("RENAME" in s for s in steps)
    with pytest.raises(KeyError):
        relational.replace_table(df, "jdbc:other://h/db", relational.ANOMALY_TABLE, {}, steps.extend, fill)
