import datetime as dt
import json
import os

import pytest

from gatetally import schemas as S
from gatetally.operators import curate, logqueries, traffic
from gatetally.session import scratch_dir
from gatetally.sources import files
from gatetally.streaming import live, sinks

START = dt.datetime(2024, 1, 1)


class Inbox:
    """A folder that files arrive in, in order."""

    def __init__(self, path):
        self.path, self.n = path, 0
        path.mkdir()

    def put(self, *rows):
        target = self.path / f"{self.n:04d}.jsonl"
        target.write_text("".join(json.dumps(r) + "\n" for r in rows))
        os.utime(target, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path / "in")


def row(minute, kind="server_request", **more):
    at = START + dt.timedelta(minutes=minute)
    base = {"student_id": "t1", "timestamp": at.strftime("%Y-%m-%dT%H:%M:%SZ"), "dt": at.strftime("%Y-%m-%d"),
            "event_type": kind, "source": "server" if kind == "server_request" else "client", "ip": "1.1.1.1",
            "request_path": "/", "status_code": 200, "latency_ms": 10}
    return {k: v for k, v in (base | more).items() if v is not None}


def raw_stream(spark, inbox, per_batch=1):
    return files.stream_clickstream(spark, str(inbox.path), per_batch)


def stream(spark, inbox, per_batch=1):
    return curate.curate_clickstream(raw_stream(spark, inbox, per_batch), "t1")


def drained(spark, df, tmp_path, name="out"):
    sinks.append_files(df, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


def test_curation_is_the_same_in_batches_and_at_once(spark, inbox, tmp_path):
    inbox.put(row(0), row(1, student_id="t2"), row(2, timestamp="x", dt=None))
    inbox.put(row(3, "purchase", event_id="5.0", amount="n/a", session_id="s"))
    got = drained(spark, stream(spark, inbox), tmp_path)
    batch = curate.curate_clickstream(files.read_clickstream(spark, str(inbox.path)), "t1")
    assert got.count() == 2
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.select(*got.columns).collect()))


def test_closed_hours_equal_the_batch_query_and_late_rows_are_dropped(spark, inbox, tmp_path):
    inbox.put(row(5, latency_ms=10), row(50, latency_ms=30, status_code=500))
    inbox.put(row(62, latency_ms=99))  # watermark 00:52
    inbox.put(row(55, latency_ms=70))  # out of order but in time
    inbox.put(row(200))  # moves the watermark past hours 0 and 1
    inbox.put(row(205))  # closes them
    inbox.put(row(30, latency_ms=5000))  # far too late
    inbox.put(row(210))
    got = drained(spark, live.endpoint_hourly_stream(stream(spark, inbox)), tmp_path)
    on_time = curate.curate_clickstream(files.read_clickstream(spark, str(inbox.path)), "t1").filter("latency_ms < 5000")
    wanted = logqueries.endpoint_hourly(on_time).filter("hour < '2024-01-01T02:00:00Z'").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    assert got.count() == 2


def busy(minute, n, **more):
    return [row(minute + i / 60, session_id=f"s{i % 3}", **more) for i in range(n)]


def batch_days(spark, inbox):
    curated = curate.curate_clickstream(files.read_clickstream(spark, str(inbox.path)), "t1")
    return traffic.anomalies(curated, ordered=False)


def same(got, wanted):
    assert sorted(map(tuple, got.select(*wanted.columns).collect())) == sorted(map(tuple, wanted.collect()))


def test_closed_days_are_exact(spark, inbox, tmp_path):
    inbox.put(*busy(10, 60), row(20, ip="2.2.2.2", session_id=None, status_code=500))
    inbox.put(*busy(600, 45), *[row(700, ip="2.2.2.2", status_code=503)] * 4)
    inbox.put(row(24 * 60 + 30))
    got = drained(spark, live.ip_anomalies_closed(stream(spark, inbox)), tmp_path)
    wanted = batch_days(spark, inbox).filter("dt = '2024-01-01'")
    assert {r["ip"]: r["reason"] for r in wanted.collect()} == {"1.1.1.1": "high_requests", "2.2.2.2": "many_errors"}
    same(got, wanted)


def test_upserted_rows_are_the_newest_after_a_rerun_and_compaction(spark, inbox, tmp_path):
    inbox.put(*busy(10, 60))
    inbox.put(*busy(600, 45), row(700, ip="2.2.2.2", session_id="s"))
    df = live.ip_anomalies_sketched(stream(spark, inbox))
    path = str(tmp_path / "metric")

    def newest(state):
        sinks.upsert_metrics(df, path, str(tmp_path / state)).awaitTermination()
        return sinks.latest_metrics(spark, path, df.schema, ["dt", "ip"])

    same(newest("first"), batch_days(spark, inbox))
    same(newest("second"), batch_days(spark, inbox))
    inbox.put(*busy(800, 5, ip="3.3.3.3"))
    same(newest("second"), batch_days(spark, inbox))
    sinks.compact_metrics(spark, path, str(tmp_path / "compact"), df.schema, ["dt", "ip"])
    path = str(tmp_path / "compact")
    inbox.put(*busy(900, 5, ip="3.3.3.3"))
    same(newest("second"), batch_days(spark, inbox))


def test_sketched_days_lead_to_the_same_flags(spark, inbox, tmp_path):
    inbox.put(*busy(10, 49), row(20, ip="2.2.2.2"))
    inbox.put(*[row(30 + i, session_id="x", ip="3.3.3.3") for i in range(50)])
    df = live.ip_anomalies_sketched(stream(spark, inbox))
    sinks.upsert_metrics(df, str(tmp_path / "m"), str(tmp_path / "state")).awaitTermination()
    got = sinks.latest_metrics(spark, str(tmp_path / "m"), df.schema, ["dt", "ip"])
    same(got, batch_days(spark, inbox))


def test_scratch_folders_are_new_and_shared(spark):
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))
