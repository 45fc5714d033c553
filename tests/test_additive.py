"""Streams of stored sums and rows against the batch form."""

from test_streaming import Inbox, batch_days, raw_stream, row, same, stream

import pytest

from gatetally.operators import curate, logqueries
from gatetally.sources import files
from gatetally.streaming import additive, digests


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path / "in")


def untimed(**more):
    return row(0, **more) | {"timestamp": "no time", "dt": "2024-01-01"}


def test_late_and_untimed_requests_count_and_a_rerun_replaces(spark, inbox, tmp_path):
    path = str(tmp_path / "sums")
    for minute in (5, 900, 30, 3000):  # the third arrives far too late for any watermark
        inbox.put(row(minute, session_id="a"), untimed(session_id="b"))
    first = additive.store_session_sums(stream(spark, inbox), path, str(tmp_path / "one"))
    first.awaitTermination()
    same(additive.ip_anomalies(spark, path), batch_days(spark, inbox))
    for minute in (6, 7, 8, 9):
        inbox.put(row(minute, session_id="c"))
    again = additive.store_session_sums(stream(spark, inbox, per_batch=8), path, str(tmp_path / "two"), run=1)
    again.awaitTermination()
    got = additive.ip_anomalies(spark, path)
    same(got, batch_days(spark, inbox))
    assert sum(r["requests"] for r in got.collect()) == 12


def test_endpoint_hours_count_late_untimed_and_last_requests(spark, inbox, tmp_path):
    path = str(tmp_path / "counts")
    for minute in (5, 900, 30, 3000):
        inbox.put(row(minute, latency_ms=minute), row(minute, latency_ms=None, status_code=500), untimed(latency_ms=7))
    for run, size in enumerate((1, 3)):
        query = additive.store_endpoint_counts(stream(spark, inbox, size), path, str(tmp_path / f"state{run}"), run)
        query.awaitTermination()
    got = additive.endpoint_hourly(spark, path)
    curated = curate.curate_clickstream(files.read_clickstream(spark, str(inbox.path)), "t1")
    wanted = logqueries.endpoint_hourly(curated).collect()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted))
    assert sum(r["requests"] for r in wanted) == 12


def test_copies_in_any_batches_are_stored_once(spark, inbox, tmp_path):
    path = str(tmp_path / "rows")
    one, no_time = row(0, session_id="a"), untimed(session_id="b")
    for rows in ([one, no_time, no_time], [no_time, row(5000)], [one, no_time, row(1)]):
        inbox.put(*rows)
    for run in (0, 1):  # a fresh start over the same files adds nothing
        query = digests.store_distinct_rows(raw_stream(spark, inbox), path, str(tmp_path / f"state{run}"), run)
        query.awaitTermination()
    got = digests.distinct_rows(spark, path)
    batch = curate.distinct_rows(files.read_clickstream(spark, str(inbox.path)))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, batch.select(*got.columns).collect()))
    assert got.count() == 4
