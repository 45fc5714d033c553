import json

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from gatetally import __main__ as command
from gatetally import schemas as S
from gatetally.operators import curate, funnel, interest, traffic
from gatetally.plans import jobs
from gatetally.sources import files, relational


@pytest.mark.parametrize("base", ["s3a://bucket/prefix", "s3a://bucket/prefix/", "file:/tmp/x/"])
def test_layer_path(base):
    assert files.layer_path(base, "/raw/", "clickstream") == base.rstrip("/") + "/raw/clickstream"


def test_json_lines_with_numbers_extras_and_broken_lines(spark, tmp_path):
    lines = [
        json.dumps({"student_id": "t1", "event_id": 5, "amount": 12.50, "latency_ms": 7, "coupon": {"code": "X"}}),
        json.dumps({"student_id": "t1", "query": "", "page": None, "status_code": "404"}),
        '{"student_id": "t1", "page": ',
        "",
        "plain text",
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    rows = dicts(files.read_clickstream(spark, f"{tmp_path}/*.jsonl", extra=("coupon",)))
    good = [r for r in rows if r["student_id"] and (r["event_id"] or r["status_code"])]
    assert [(r["event_id"], r["amount"], r["latency_ms"], r["query"]) for r in good] == [
        ("5", "12.5", "7", None), (None, None, None, ""),
    ]
    assert json.loads(good[0]["coupon"]) == {"code": "X"}
    curated = curate.curate_clickstream(files.read_clickstream(spark, f"{tmp_path}/*.jsonl"), "t1")
    assert curated.count() == 0  # none has a day


def test_csv_keeps_text_and_reads_empty_cells_as_null(spark, tmp_path):
    path = tmp_path / "events.csv"
    header = ",".join(S.CATALOG_RAW.fieldNames())
    path.write_text(f'{header}\n007,"Show, ""Live""",,music,2024-02-03,12.50,,1, two words ,x\n')
    (row,) = dicts(files.read_csv(spark, str(path), S.CATALOG_RAW))
    assert (row["event_id"], row["name"], row["city"], row["base_price"], row["capacity"]) == (
        "007", 'Show, "Live"', None, "12.50", None,
    )
    assert row["description"] == " two words "


def test_layer_types_survive_a_round_trip(spark, clicks, tmp_path):
    df = clicks(
        {"dt": "unknown", "event_type": "purchase", "event_id": 3, "amount": 1.5},
        {"dt": "2024-01-01", "event_type": "a/b c", "ip": "1"},
    )
    files.write_layer(df, str(tmp_path / "l"), ("dt", "event_type"))
    back = files.read_layer(spark, str(tmp_path / "l"), S.CLICK_CURATED)
    assert back.schema == S.CLICK_CURATED
    assert sorted(map(repr, dicts(back))) == sorted(map(repr, dicts(df)))


def test_null_days_and_flags_survive_a_round_trip(spark, clicks, tmp_path):
    df = traffic.anomalies(clicks({"event_type": "server_request", "ip": "1", "status_code": 200}), ordered=False)
    files.write_layer(df, str(tmp_path / "l"), S.LAYER_KEYS["metrics_anomalies"])
    back = files.read_layer(spark, str(tmp_path / "l"), S.ANOMALY)
    assert back.schema == S.ANOMALY
    assert [(r["is_anomaly"], r["reason"]) for r in back.collect()] == [(None, "normal")]


def test_a_layer_is_replaced_as_a_whole(spark, clicks, tmp_path):
    path, keys = str(tmp_path / "l"), ("dt", "event_type")
    files.write_layer(clicks({"dt": "1", "event_type": "a", "page": "old"}, {"dt": "2", "event_type": "a"}), path, keys)
    files.write_layer(clicks({"dt": "2", "event_type": "b", "page": "new"}), path, keys)
    assert [(r["dt"], r["page"]) for r in files.read_layer(spark, path, S.CLICK_CURATED).collect()] == [("2", "new")]


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    ids = spark.range(0, 60000, numPartitions=8)
    rows = ids.select(
        F.lit("hot").alias("dt"), F.lit("a").alias("event_type"), F.sha2(F.col("id").cast("string"), 512).alias("page")
    )
    rows = curate.with_missing(rows, S.CLICK_CURATED)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        files.write_layer(rows, str(tmp_path / "l"), ("dt", "event_type"))
    finally:
        spark.conf.set(size, usual)
    assert len(list((tmp_path / "l" / "dt=hot" / "event_type=a").glob("*.parquet"))) > 1
    assert files.read_layer(spark, str(tmp_path / "l"), S.CLICK_CURATED).count() == 60000


@pytest.fixture
def lake(tmp_path):
    raw = tmp_path / "raw"
    (raw / "clickstream").mkdir(parents=True)
    (raw / "business").mkdir()
    click = {"student_id": "t1", "timestamp": "2024-01-05T10:00:00Z", "dt": "2024-01-05", "source": "client"}
    events = [
        click | {"session_id": "s1", "event_type": "view_event_detail", "event_id": 1},
        click | {"session_id": "s1", "event_type": "view_event_detail", "event_id": 1},
        click | {"session_id": "s1", "event_type": "purchase", "event_id": 1, "amount": 10.0},
        click | {"source": "server", "event_type": "server_request", "ip": "1.1.1.1", "status_code": 200, "latency_ms": 1500.5},
        click | {"student_id": "other"},
    ]
    (raw / "clickstream" / "a.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events) + "{broken\n")
    tables = {
        "events": (S.CATALOG_RAW, ["1,Show,Here,music,2024-02-01,12.5,100,1,,", "2,Bad,,music,x,free,1,1,,"]),
        "campaigns": (S.CAMPAIGN_RAW, ["1,c1,email,100,2024-01-01,2024-01-30,"]),
        "transactions": (
            S.TX_RAW,
            ["t1,2024-01-05T10:00:00Z,2024-01-05,s1,1,1,10.0,card,,", "t2,,2024-01-05,s2,99,1,10.0,cash,,"],
        ),
    }
    for name, (schema, rows) in tables.items():
        (raw / "business" / f"{name}.csv").write_text("\n".join([",".join(schema.fieldNames()), *rows]) + "\n")
    return str(tmp_path)


def counts(df):
    return {r["layer"]: r["n_rows"] for r in df.collect()}


def test_jobs_from_raw_files_to_metrics(spark, lake):
    assert counts(jobs.curate_all(spark, lake, "t1")) == {
        "clickstream": 4, "events": 1, "campaigns": 1, "transactions": 2,
    }
    again = counts(jobs.curate_all(spark, lake, "t1", strict=True))
    assert again == {"clickstream": 3, "events": 1, "campaigns": 1, "transactions": 1}
    assert counts(jobs.analyse_all(spark, lake)) == {
        "metrics_funnel_daily": 1, "metrics_event_rank": 1, "metrics_anomalies": 1,
    }
    clicks = jobs.open_layer(spark, lake, "curated", jobs.CURATED)["clickstream"]
    stored = jobs.open_layer(spark, lake, "analytics", jobs.ANALYTICS)
    fresh = {
        "metrics_funnel_daily": funnel.funnel_daily(clicks),
        "metrics_event_rank": interest.event_rank(clicks),
        "metrics_anomalies": traffic.anomalies(clicks),
    }
    for name, df in stored.items():
        assert dicts(df) == dicts(fresh[name].select(*df.columns))


def test_command_line_runs_both_jobs(spark, lake):
    curated = command.run(spark, command.parsed(["curate", "--base", lake, "--tenant", "t1", "--strict"]))
    assert counts(curated)["clickstream"] == 3
    analysed = command.run(spark, command.parsed(["analyse", "--base", lake]))
    assert counts(analysed)["metrics_funnel_daily"] == 1
    with pytest.raises(SystemExit):
        command.parsed(["curate", "--base", lake])


def test_published_tables_come_from_the_stored_metrics(spark, lake, monkeypatch):
    sent = {}

    def capture(df, url, table, options, keep_definition):
        sent[table.name] = (url, options, keep_definition, relational.sink_frame(df, table).collect())

    monkeypatch.setattr(relational, "write_jdbc", capture)
    jobs.curate_all(spark, lake, "t1")
    jobs.analyse_all(spark, lake, jobs.Database("jdbc:x", {"user": "u"}, True))
    assert {name: got[:3] for name, got in sent.items()} == dict.fromkeys(jobs.ANALYTICS, ("jdbc:x", {"user": "u"}, True))
    (funnel_row,), (rank_row,), (anomaly_row,) = (sent[name][3] for name in jobs.ANALYTICS)
    assert str(funnel_row["dt"]) == "2024-01-05"
    assert (rank_row["event_id"], rank_row["revenue_total"], rank_row["interest_to_purchase_ratio"]) == (1, 10.0, 2.0)
    assert (anomaly_row["reason"], anomaly_row["avg_latency_ms"]) == ("high_latency", 1500.5)


def test_a_failed_write_is_reported(spark, lake):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.analyse_all(spark, lake)
