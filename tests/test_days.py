"""Layers in which whole days are replaced."""

import pytest
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.plans import jobs
from gatetally.sources import days

KEYS = S.LAYER_KEYS["metrics_anomalies"]


@pytest.fixture
def anomalies(spark):
    def make(*rows):
        full = [(dt, ip, n, 0, 0, 1, 1.0, 1.0, flag, "r") for dt, ip, n, flag in rows]
        return spark.createDataFrame(full, S.ANOMALY)

    return make


def shown(spark, path):
    rows = days.read_days(spark, path, S.ANOMALY).select("dt", "ip", "requests", "is_anomaly").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_a_day_written_again_has_one_row_for_each_key(spark, anomalies, tmp_path):
    path = str(tmp_path / "layer")
    days.write_days(anomalies(("2024-01-01", "1.1.1.1", 150, True), ("2024-01-02", "1.1.1.1", 9, False)), path, KEYS)
    days.write_days(anomalies(("2024-01-01", "1.1.1.1", 60, False)), path, KEYS)
    assert shown(spark, path) == [("2024-01-01", "1.1.1.1", 60, False), ("2024-01-02", "1.1.1.1", 9, False)]


def test_a_writer_that_stops_midway_changes_nothing(spark, anomalies, tmp_path):
    path = str(tmp_path / "layer")
    assert shown(spark, path) == []
    days.stage_days(anomalies(("2024-01-01", "9.9.9.9", 1, True)), path, KEYS)
    assert shown(spark, path) == []
    days.write_days(anomalies(("2024-01-01", "1.1.1.1", 150, True)), path, KEYS)
    days.stage_days(anomalies(("2024-01-01", "1.1.1.1", 60, False)), path, KEYS)
    broken = anomalies(("2024-01-01", "1.1.1.1", 60, False)).withColumn("requests", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        days.write_days(broken, path, KEYS)
    assert shown(spark, path) == [("2024-01-01", "1.1.1.1", 150, True)]


def test_named_days_without_rows_become_empty(spark, anomalies, tmp_path):
    path = str(tmp_path / "layer")
    days.write_days(anomalies(("2024-01-01", "a", 1, True), ("2024-01-02", "b", 2, True), (None, "c", 3, True)), path, KEYS)
    days.write_days(anomalies(("2024-01-02", "d", 4, False)), path, KEYS, ["2024-01-01", "2024-01-02"])
    assert shown(spark, path) == [("2024-01-02", "d", 4, False), (None, "c", 3, True)]
    days.write_days(anomalies((None, "e", 5, True)), path, KEYS)
    assert shown(spark, path) == [("2024-01-02", "d", 4, False), (None, "e", 5, True)]
    with pytest.raises(ValueError, match="2024-02-01"):
        days.write_days(anomalies(("2024-02-01", "f", 6, True)), path, KEYS, ["2024-01-01"])
    assert len(shown(spark, path)) == 2


def test_replacing_the_whole_layer_and_starting_afresh(spark, anomalies, tmp_path):
    path, fresh = str(tmp_path / "layer"), str(tmp_path / "fresh")
    days.write_days(anomalies(("2024-01-01", "a", 1, True), ("2024-01-02", "b", 2, True)), path, KEYS)
    days.write_days(anomalies(("2024-01-02", "c", 3, True), ("2024-01-03", "d", 4, True)), path, KEYS, whole=True)
    assert [r[1] for r in shown(spark, path)] == ["c", "d"]
    days.write_days(anomalies(("2024-01-02", "e", 5, True)), path, KEYS)
    assert [r[1] for r in shown(spark, path)] == ["e", "d"]
    days.rewrite_days(spark, path, fresh, S.ANOMALY, KEYS)
    assert shown(spark, fresh) == shown(spark, path)


def test_only_the_stages_and_days_wanted_are_read(spark, anomalies, tmp_path):
    path = str(tmp_path / "layer")
    for n in range(3):
        days.write_days(anomalies(("2024-01-01", "a", n, True), (f"2024-01-1{n}", "b", n, True)), path, KEYS)
    plan = days.read_days(spark, path, S.ANOMALY).filter("dt = '2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "stage" in plan.split("PartitionFilters: [")[1]
    files = days.read_days(spark, path, S.ANOMALY).select(F.input_file_name().alias("f")).distinct()
    assert files.count() == 4


def test_the_first_key_must_be_the_day(spark, anomalies, tmp_path):
    with pytest.raises(ValueError, match="dt"):
        days.write_days(anomalies(("2024-01-01", "a", 1, True)), str(tmp_path / "x"), ("is_anomaly", "dt"))


def test_analysing_some_days_again(spark, clicks, tmp_path):
    base = str(tmp_path)

    def request(dt, ip, n):
        return [{"dt": dt, "ip": ip, "event_type": "server_request", "session_id": f"s{i}", "status_code": 200} for i in range(n)]

    def curated(rows, days_given=None):
        days.write_days(clicks(*rows), f"{base}/curated/clickstream", S.LAYER_KEYS["clickstream"], days_given)

    curated(request("2024-01-01", "1.1.1.1", 150) + request("2024-01-02", "1.1.1.1", 120))
    jobs.analyse_all(spark, base, replace="days")
    curated(request("2024-01-01", "1.1.1.1", 60), ["2024-01-01"])
    counts = jobs.analyse_all(spark, base, replace="days", some_days=["2024-01-01"])
    assert {r["layer"]: r["n_rows"] for r in counts.collect()}["metrics_anomalies"] == 2
    assert shown(spark, f"{base}/analytics/metrics_anomalies") == [
        ("2024-01-01", "1.1.1.1", 60, None),
        ("2024-01-02", "1.1.1.1", 120, True),
    ]
