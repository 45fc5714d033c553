"""Runs of a stream, the index of digests, attribution of events in any order."""

import random

import pytest
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.operators import attribution
from gatetally.operators.curate import client_events
from gatetally.operators.logqueries import endpoint_hourly
from gatetally.operators.traffic import anomalies
from gatetally.streaming import additive, digests, runs, visits


def requests(clicks, n, ip="1.1.1.1", dt="2024-01-01"):
    row = {"dt": dt, "ip": ip, "event_type": "server_request", "status_code": 200, "latency_ms": 5.0}
    return clicks(*[row | {"session_id": f"s{i}"} for i in range(n)])


def total(spark, path):
    return {r["ip"]: r["requests"] for r in additive.ip_anomalies(spark, path).collect()}


@pytest.fixture
def store(tmp_path):
    path = str(tmp_path / "sums")

    def write(rows, run, batch):
        additive.sums_writer(additive.session_sums, additive.SESSION_SUMS, path, run)(rows, batch)

    write.path = path
    return write


# Runs


def test_a_rerun_is_seen_once_it_has_caught_up(spark, clicks, store):
    for batch in range(2):
        store(requests(clicks, 4, f"{batch}.1.1.1"), 0, batch)
    old = {"0.1.1.1": 4, "1.1.1.1": 4}
    assert total(spark, store.path) == old
    store(requests(clicks, 2, "2.1.1.1"), 1, 0)
    assert total(spark, store.path) == old
    store(requests(clicks, 6, "3.1.1.1"), 1, 1)
    assert total(spark, store.path) == {"2.1.1.1": 2, "3.1.1.1": 6}


def test_a_smaller_rerun_is_seen_when_it_is_closed(spark, clicks, store):
    store(requests(clicks, 9), 0, 0)
    store(requests(clicks, 3), 1, 0)
    assert total(spark, store.path) == {"1.1.1.1": 9}
    runs.close_run(spark, store.path, 1)
    assert total(spark, store.path) == {"1.1.1.1": 3}


def test_a_repeated_batch_and_one_without_a_record(spark, clicks, store):
    store(requests(clicks, 4), 0, 0)
    store(requests(clicks, 4), 0, 0)
    runs.store_rows(additive.session_sums(requests(clicks, 50)), store.path, 0, 1)
    assert total(spark, store.path) == {"1.1.1.1": 4}
    store(requests(clicks, 5), 0, 1)
    assert total(spark, store.path) == {"1.1.1.1": 9}


def test_batches_merged_while_a_stream_goes_on(spark, clicks, store):
    everything = None
    for batch in range(3):
        rows = requests(clicks, 5 + batch, f"{batch % 2}.1.1.1")
        everything = rows if everything is None else everything.unionByName(rows)
        store(rows, 0, batch)
    assert runs.merge_batches(spark, store.path, additive.SESSION_SUMS, additive.merged_sessions) == runs.View(0, 2, 2)
    key = ["dt", "ip", "requests", "sessions", "avg_latency_ms"]
    want = sorted(map(tuple, anomalies(everything).select(key).collect()))
    assert sorted(map(tuple, additive.ip_anomalies(spark, store.path).select(key).collect())) == want
    files = runs.newest_run(spark, store.path, additive.SESSION_SUMS).select(F.input_file_name().alias("f"))
    assert all(f"{runs.BATCH}=-3" in r["f"] for r in files.distinct().collect())
    store(requests(clicks, 7, "7.1.1.1"), 0, 3)
    assert total(spark, store.path)["7.1.1.1"] == 7
    assert runs.merge_batches(spark, store.path, additive.SESSION_SUMS, additive.merged_sessions).upto == 3
    assert total(spark, store.path) == {"0.1.1.1": 12, "1.1.1.1": 6, "7.1.1.1": 7}
    assert runs.merge_batches(spark, store.path, additive.SESSION_SUMS, additive.merged_sessions).upto == 3


def test_nothing_stored_yet(spark, tmp_path):
    assert runs.newest_run(spark, str(tmp_path / "none"), additive.SESSION_SUMS).count() == 0
    assert runs.merge_batches(spark, str(tmp_path / "none"), additive.SESSION_SUMS, additive.merged_sessions) is None


# Digests


@pytest.fixture
def index(spark, raw, tmp_path):
    path = str(tmp_path / "rows")
    for schema, place, keys in (
        (digests.STORED, path, (digests.DAY, digests.BUCKET)),
        (digests.FILTERS, f"{path}/_filters", (digests.DAY,)),
    ):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*keys, runs.RUN, runs.BATCH).parquet(place)

    class Index:
        def rows(self, *pairs):
            return raw(S.CLICK_RAW, *[{"dt": dt, "session_id": s} for dt, s in pairs])

        def write(self, batch, *pairs, run=0):
            digests.distinct_writer(path, run)(self.rows(*pairs), batch)

        def kept(self):
            rows = digests.distinct_rows(spark, path).select("dt", "session_id").collect()
            return sorted(map(tuple, rows), key=repr)

    made = Index()
    made.path = path
    return made


def test_copies_far_apart_and_batches_repeated(index):
    index.write(0, ("2024-01-01", "a"), ("2024-01-01", "a"), (None, "n"), ("x/../y", "odd"))
    index.write(1, ("2024-01-01", "a"), ("2024-01-01", "b"), (None, "n"), ("2024-01-02", "a"))
    index.write(1, ("2024-01-01", "a"), ("2024-01-01", "b"), (None, "n"), ("2024-01-02", "a"))
    index.write(2, ("x/../y", "odd"), ("x/../z", "odd"), ("2024-01-02", "a"))
    assert index.kept() == sorted(
        [("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "a"), (None, "n"), ("x/../y", "odd"), ("x/../z", "odd")],
        key=repr,
    )


def test_only_folders_that_may_hold_copies_are_read(spark, index):
    for batch in range(4):
        index.write(batch, *[(f"2024-01-0{1 + batch}", f"s{n}") for n in range(200)])
    new = digests.keyed_rows(index.rows(*[("2024-01-04", f"t{n}") for n in range(50)], ("2024-01-04", "s3")))
    seen = digests.seen_digests(new, index.path, 0, 9)
    files = [r["f"] for r in seen.select(F.input_file_name().alias("f")).distinct().collect()]
    assert 1 <= len(files) <= 3 and all("day=2024-01-04" in f for f in files)
    plan = seen._jdf.queryExecution().toString()
    assert "2024-01-04" in plan.split("PartitionFilters")[1] and "2024-01-01" not in plan
    other_day = digests.keyed_rows(index.rows(("2024-02-01", "s3")))
    assert digests.seen_digests(other_day, index.path, 0, 9).count() == 0


def test_a_late_batch_reads_no_more_than_an_early_one(spark, index):
    read = []
    for batch in range(7):
        rows = [("2024-01-01", f"b{batch}-{n}") for n in range(300)]
        seen = digests.seen_digests(digests.keyed_rows(index.rows(*rows)), index.path, 0, batch)
        read.append(seen.count())
        index.write(batch, *rows)
    assert len(index.kept()) == 2100 and max(read[3:]) <= 300


def test_filters_never_deny_what_they_have(spark, index):
    rng = random.Random(3)
    pairs = [(f"2024-01-{rng.randint(1, 28):02d}", f"s{rng.randint(0, 10**9)}") for _ in range(3000)]
    keyed = digests.keyed_rows(index.rows(*pairs)).persist()
    filters = digests.filters_of(keyed)
    maybe = digests.may_have(keyed, filters)
    assert maybe.count() == keyed.select("day", "bucket").distinct().count()
    others = digests.keyed_rows(index.rows(*[(d, s + "x") for d, s in pairs]))
    asked = others.select("day", "bucket").distinct().count()
    assert digests.may_have(others, filters).count() < asked / 2


# Attribution


def told(df):
    columns = ["session_id", "event_ts", "event_id", "attr_campaign", "attr_referrer", "first_seen_ts"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


def test_attribution_of_events_in_any_order(spark, clicks, tmp_path):
    from datetime import datetime, timedelta

    rng = random.Random(4)
    start, batches = datetime(2024, 1, 1), []
    for b in range(4):
        rows = []
        for n in range(60):
            at = None if n % 13 == 0 else start + timedelta(minutes=rng.randint(0, 90))
            rows.append(
                {
                    "session_id": f"s{rng.randint(0, 4)}" if n % 17 else None,
                    "source": "client",
                    "event_type": "click",
                    "event_id": b * 100 + n,
                    "event_ts": at,
                    "utm_campaign": rng.choice([None, None, "c1", "c2", "c3"]),
                    "referrer": rng.choice([None, "r1", "r2"]),
                }
            )
        batches.append(clicks(*rows))
    source = str(tmp_path / "in")
    for b, frame in enumerate(batches):
        frame.coalesce(1).write.mode("append").parquet(source)
    from gatetally.session import stream_session

    stream = stream_session(spark).readStream.schema(S.CLICK_CURATED).option("maxFilesPerTrigger", 1).parquet(source)
    path, checkpoint = str(tmp_path / "told"), str(tmp_path / "checkpoint")
    visits.store_attribution(stream, path, checkpoint, "30 days").awaitTermination()
    everything = spark.read.schema(S.CLICK_CURATED).parquet(source)
    want = told(attribution.session_attribution(everything))
    assert told(visits.attributed(spark, path, everything)) == want
    assert len(want) == client_events(everything).count()
    later = clicks({"session_id": "s1", "source": "client", "event_ts": start - timedelta(minutes=1), "utm_campaign": "c9"})
    later.coalesce(1).write.mode("append").parquet(source)
    visits.store_attribution(stream, path, checkpoint, "30 days").awaitTermination()
    everything = spark.read.schema(S.CLICK_CURATED).parquet(source)
    assert told(visits.attributed(spark, path, everything)) == told(attribution.session_attribution(everything))


def test_a_silent_session_is_folded_and_goes_on_from_its_summary(spark, clicks, tmp_path):
    from datetime import datetime, timedelta

    from gatetally.session import stream_session

    start = datetime(2024, 1, 1)

    def at(minutes, session, **more):
        return {"session_id": session, "source": "client", "event_ts": start + timedelta(minutes=minutes)} | more

    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "told", "checkpoint"))
    steps = [
        [at(0, "a", utm_campaign="c1", referrer="r1", event_id=1)],
        [at(60, "b", event_id=2)],
        [at(62, "b", event_id=3)],
        [at(64, "a", event_id=4)],
    ]
    for step in steps:
        clicks(*step).coalesce(1).write.mode("append").parquet(source)
        stream = stream_session(spark).readStream.schema(S.CLICK_CURATED).parquet(source)
        visits.store_attribution(stream, path, checkpoint, "40 minutes").awaitTermination()
    everything = spark.read.schema(S.CLICK_CURATED).parquet(source)
    assert told(visits.attributed(spark, path, everything)) == told(attribution.session_attribution(everything))


def test_a_session_silent_for_long_keeps_what_it_knew(spark, clicks, tmp_path):
    from datetime import datetime, timedelta

    from gatetally.session import stream_session

    def at(minutes, session, **more):
        seen = datetime(2024, 1, 1) + timedelta(minutes=minutes)
        return {"session_id": session, "source": "client", "event_ts": seen} | more

    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "told", "checkpoint"))
    steps = [[at(0, "a", utm_campaign="c1", referrer="r1")], *[[at(m, "b")] for m in (60, 120, 180)], [at(182, "a")]]
    for step in steps:
        clicks(*step).coalesce(1).write.mode("append").parquet(source)
        stream = stream_session(spark).readStream.schema(S.CLICK_CURATED).parquet(source)
        visits.store_attribution(stream, path, checkpoint, "10 minutes").awaitTermination()
    everything = spark.read.schema(S.CLICK_CURATED).parquet(source)
    found = told(visits.attributed(spark, path, everything))
    assert found == told(attribution.session_attribution(everything))
    assert [r[3] for r in found if r[0] == "a"] == ["c1", "c1"]


def test_stored_endpoint_counts_merge(spark, clicks, tmp_path):
    from datetime import datetime

    path = str(tmp_path / "counts")
    rows = [
        {"event_type": "server_request", "request_path": "/", "event_ts": datetime(2024, 1, 1, 5, n % 60)}
        | {"latency_ms": float(n % 7), "status_code": 200 + n % 3}
        for n in range(90)
    ]
    write = additive.sums_writer(additive.endpoint_counts, additive.ENDPOINT_COUNTS, path, 0)
    for batch in range(3):
        write(clicks(*rows[batch::3]), batch)
    runs.merge_batches(spark, path, additive.ENDPOINT_COUNTS, additive.merged_endpoints)
    found, want = additive.endpoint_hourly(spark, path), endpoint_hourly(clicks(*rows))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.select(found.columns).collect()))
