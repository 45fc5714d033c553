"""One literal row per kind of fault and what curation makes of it."""

import datetime as dt
import math

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from gatetally import schemas as S
from gatetally.functions import cells as C
from gatetally.functions.rounding import exact_sum, steady_round
from gatetally.operators import curate, joins

CLICK = {"student_id": "t1", "timestamp": "2024-01-05T23:30:00.125Z", "dt": "2024-01-05", "source": "client"}
EVENT = {
    "event_id": "7", "name": "Show", "city": "Here", "category": "music", "event_date": "2024-02-03",
    "base_price": "12.5", "capacity": "300", "is_active": "1",
}
CAMPAIGN = {"utm_campaign": "c", "channel": "email", "monthly_cost": "10.5", "start_dt": "2024-01-01"}
TX = {
    "transaction_id": "tx", "timestamp": "2024-01-05T10:00:00+00:00", "dt": "2024-01-05", "session_id": "s",
    "event_id": "7", "quantity": "1", "amount": "9.99", "payment_method": "card",
}


def cell(spark, text, expr):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, number",
    [("12", 12), (" 12 ", 12), ("-3", -3), ("+3", 3), ("12.0", 12), ("12.9", 12), ("-1.5", -1), ("7.", 7),
     ("1e3", None), ("abc", None), ("", None), (None, None), ("1.2.3", None), ("99999999999999999999", None)],
)
def test_whole_number(spark, text, number):
    assert cell(spark, text, C.whole_number) == number


@pytest.mark.parametrize("text, number", [("1.5", 1.5), ("free", None), ("", None), ("-12.5", -12.5), ("1e3", 1000.0)])
def test_real_number(spark, text, number):
    assert cell(spark, text, C.real_number) == number


def test_nan_text_is_a_number_outside_every_range(spark):
    assert math.isnan(cell(spark, "NaN", C.real_number))
    assert cell(spark, "NaN", lambda x: C.between_open(C.real_number(x), 0, 5000)) is False


@pytest.mark.parametrize("text", ["not-a-ts", "2024/02/01 10:00:00", "", None, "10-04-2026"])
def test_bad_times_are_null(spark, text):
    assert cell(spark, text, C.instant) is None


@pytest.mark.parametrize(
    "text, hour", [("2024-01-05T10:00:00Z", 10), ("2024-01-05 10:00:00", 10), ("2024-01-05T10:00:00+02:00", 8)]
)
def test_times_are_read_as_utc(spark, text, hour):
    assert cell(spark, text, lambda x: F.hour(C.instant(x))) == hour


@pytest.mark.parametrize(
    "given, stamp, day",
    [("2024-01-05", None, "2024-01-05"), ("not-a-date", None, "not-a-date"), ("2024-1-5", "2024-01-06T00:00:00Z",
      "2024-01-06"), (None, "2024-01-06T23:59:59Z", "2024-01-06"), ("", "x", None), (None, None, None)],
)
def test_day_is_kept_repaired_or_dropped(raw, given, stamp, day):
    rows = raw(S.CLICK_RAW, CLICK | {"dt": given, "timestamp": stamp})
    assert [r["dt"] for r in dicts(curate.curate_clickstream(rows, "t1"))] == ([day] if day else [])


def test_click_types_labels_and_tenant(raw):
    rows = raw(
        S.CLICK_RAW,
        CLICK | {"event_type": None, "source": None, "event_id": "5", "amount": "bad", "status_code": "200"},
        CLICK | {"student_id": "t2"},
        {"student_id": None},
    )
    (row,) = dicts(curate.curate_clickstream(rows, "t1"))
    assert (row["event_type"], row["source"], row["event_id"], row["amount"], row["status_code"]) == (
        "unknown", "unknown", 5, None, 200,
    )
    assert row["event_ts"] == dt.datetime(2024, 1, 5, 23, 30, 0, 125000)


def test_click_schema_is_the_contract_even_when_columns_are_missing(spark, raw):
    few = raw(S.CLICK_RAW, CLICK).select("student_id", "timestamp", "dt")
    curated = curate.curate_clickstream(few, "t1")
    assert {f.name: f.dataType for f in curated.schema} == {f.name: f.dataType for f in S.CLICK_CURATED}
    assert curated.count() == 1


@pytest.mark.parametrize(
    "fault, kept",
    [({}, True), ({"city": ""}, False), ({"city": "  "}, False), ({"category": None}, False), ({"name": ""}, False),
     ({"base_price": "free"}, False), ({"base_price": "-12.5"}, False), ({"base_price": "999999"}, False),
     ({"base_price": "0"}, False), ({"base_price": "1000"}, False), ({"base_price": "999.99"}, True),
     ({"event_id": "x"}, False), ({"capacity": "one thousand"}, True), ({"capacity": "N/A"}, True),
     ({"is_active": "0"}, True), ({"event_date": "not-a-date"}, True)],
)
def test_catalog_faults(raw, fault, kept):
    assert curate.curate_catalog(raw(S.CATALOG_RAW, EVENT | fault)).count() == kept


@pytest.mark.parametrize("date", ["2026/04/10", "10-04-2026", "not-a-date", None])
def test_catalog_with_a_bad_date_goes_to_the_unknown_day(raw, date):
    (row,) = dicts(curate.curate_catalog(raw(S.CATALOG_RAW, EVENT | {"event_date": date, "capacity": "N/A"})))
    assert (row["dt"], row["event_dt"], row["capacity"], row["event_date"]) == ("unknown", None, None, date)


@pytest.mark.parametrize(
    "fault, kept",
    [({}, True), ({"channel": None}, False), ({"channel": "radio"}, False), ({"monthly_cost": "-50"}, False),
     ({"monthly_cost": "unknown"}, False), ({"monthly_cost": "1000000"}, False), ({"monthly_cost": "0"}, True),
     ({"monthly_cost": "100000"}, False), ({"utm_campaign": None}, False), ({"utm_campaign": " "}, False)],
)
def test_campaign_faults(raw, fault, kept):
    assert curate.curate_campaigns(raw(S.CAMPAIGN_RAW, CAMPAIGN | fault)).count() == kept


def test_campaign_without_start_goes_to_the_unknown_day(raw):
    (row,) = dicts(curate.curate_campaigns(raw(S.CAMPAIGN_RAW, CAMPAIGN | {"start_dt": None})))
    assert row["dt"] == "unknown"


@pytest.mark.parametrize(
    "fault, kept",
    [({}, True), ({"amount": None}, False), ({"amount": "-9.99"}, False), ({"amount": "NaN"}, False),
     ({"amount": "9999999"}, False), ({"amount": "0"}, False), ({"amount": "5000"}, False),
     ({"amount": "4999.99"}, True), ({"payment_method": "paypal"}, False), ({"payment_method": None}, False),
     ({"transaction_id": None}, False), ({"session_id": " "}, False), ({"event_id": None}, False),
     ({"timestamp": "not-a-ts"}, True), ({"timestamp": None, "dt": None}, True), ({"event_id": "999999"}, True)],
)
def test_transaction_faults(raw, fault, kept):
    assert curate.curate_transactions(raw(S.TX_RAW, TX | fault)).count() == kept


def test_transaction_without_any_day_keeps_a_null_day(raw):
    (row,) = dicts(curate.curate_transactions(raw(S.TX_RAW, TX | {"timestamp": "2024/02/01 10:00:00", "dt": None})))
    assert (row["dt"], row["tx_ts"]) == (None, None)


def test_orphans_and_known_sales_make_up_all_sales(raw):
    sales = curate.curate_transactions(
        raw(S.TX_RAW, TX, TX | {"transaction_id": "o", "event_id": "8"}, TX | {"transaction_id": "p"})
    )
    catalog = curate.curate_catalog(raw(S.CATALOG_RAW, EVENT, EVENT | {"name": "Again"}))
    known, lost = joins.known_events(sales, catalog), joins.orphan_sales(sales, catalog)
    assert sorted(r["transaction_id"] for r in known.collect()) == ["p", "tx"]
    assert [r["transaction_id"] for r in lost.collect()] == ["o"]
    assert known.columns == lost.columns == sales.columns


def test_curation_is_idempotent(raw):
    once = curate.curate_clickstream(raw(S.CLICK_RAW, CLICK, CLICK | {"event_id": "5.0", "dt": None}), "t1")
    as_text = once.select(*[F.col(c).cast("string") for c in S.CLICK_RAW.fieldNames()])
    again = curate.curate_clickstream(as_text, "t1")
    assert sorted(map(repr, dicts(again))) == sorted(map(repr, dicts(once)))


def test_copies_collapse_and_near_copies_stay(raw):
    rows = raw(S.CLICK_RAW, CLICK, CLICK, CLICK | {"page": "/"}, CLICK | {"dt": None}, CLICK)
    assert curate.distinct_rows(rows).count() == 3


@pytest.mark.parametrize(
    "fault, shown",
    [({}, True), ({"is_active": "0"}, False), ({"is_active": None}, False), ({"base_price": "free"}, False),
     ({"base_price": "-12.5"}, True), ({"base_price": "999999"}, True), ({"base_price": "12.5f"}, False),
     ({"base_price": None}, False), ({"event_date": ""}, False), ({"event_date": "not-a-date"}, True)],
)
def test_web_catalog(raw, fault, shown):
    assert curate.web_catalog(raw(S.CATALOG_RAW, EVENT | fault)).count() == shown


@pytest.mark.parametrize(
    "forwarded, peer, ip",
    [("1.2.3.4", "9.9.9.9", "1.2.3.4"), (" 1.2.3.4 , 5.6.7.8", None, "1.2.3.4"), ("", "9.9.9.9", "9.9.9.9"),
     (None, "9.9.9.9", "9.9.9.9"), (None, None, "unknown"), (",5.6.7.8", "9.9.9.9", "")],
)
def test_client_address(spark, forwarded, peer, ip):
    df = spark.createDataFrame([(forwarded, peer)], "f string, p string")
    assert df.select(C.first_forwarded(F.col("f"), F.col("p"))).first()[0] == ip


def test_collected_event_keeps_the_day_written_in_its_own_time(spark):
    names = [*S.CLICK_RAW.fieldNames(), "forwarded_for", "peer", "agent", "referer", "path"]
    schema = ", ".join(f"{n} string" for n in names) + ", ingest_ts timestamp"
    at = dt.datetime(2024, 3, 1, 12, 0, 0, 5)
    rows = [
        {"timestamp": "2024-01-05T23:30:00-05:00", "source": "server"},
        {"timestamp": "", "page": ""},
        {"timestamp": "2024-1-5", "dt": "", "referer": "r"},
    ]
    df = spark.createDataFrame([tuple([r.get(n) for n in names] + [at]) for r in rows], schema)
    got = dicts(curate.ingest_defaults(df.withColumn("path", F.lit("/track")), "t9"))
    assert [r["dt"] for r in got] == ["2024-01-05", "2024-03-01", "2024-03-01"]
    assert got[1]["timestamp"] == "2024-03-01T12:00:00.000005+00:00"
    assert [r["page"] for r in got] == ["/track", "/track", "r"]
    assert {(r["student_id"], r["source"], r["ip"]) for r in got} == {("t9", "client", "unknown")}


def test_retention_reads_recent_days_only(clicks):
    df = clicks({"dt": "2024-01-16"}, {"dt": "2024-01-17"}, {"dt": "2024-01-31"})
    assert [r["dt"] for r in curate.retained(df, 14, "2024-01-31").collect()] == ["2024-01-17", "2024-01-31"]


def test_retention_keeps_keys_that_are_no_date(clicks):
    df = clicks(*({"dt": d} for d in ("10-04-2024", "2023/12/01", "unknown", None, "2024-02-20", "2023-12-01")))
    kept = [r["dt"] for r in curate.retained(df, 14, "2024-01-31").collect()]
    assert kept == ["10-04-2024", "2023/12/01", "unknown", None]


@pytest.mark.parametrize("partitions", [3, 7, 13])
def test_money_sums_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(200_000).select((F.col("id") * 7.13 + 999_999.1).alias("x")).repartition(partitions)
    total = df.agg(exact_sum(F.col("x")).alias("s")).first()["s"]
    once = spark.range(200_000, numPartitions=1).select((F.col("id") * 7.13 + 999_999.1).alias("x"))
    assert total == once.agg(exact_sum(F.col("x"))).first()[0]
    assert math.isclose(total, math.fsum(r["x"] for r in once.collect()), rel_tol=1e-13)
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert math.isnan(nan.agg(exact_sum(F.col("x"))).first()[0])


@pytest.mark.parametrize(
    "number, digits, rounded",
    [(1.005, 2, 1.01), (2.125, 2, 2.13), (1.0049999999999999, 2, 1.01), (-1.005, 2, -1.01), (0.1 + 0.2, 2, 0.3),
     (float("inf"), 2, float("inf")), (1e300, 2, 1e300), (None, 2, None)],
)
def test_steady_round(spark, number, digits, rounded):
    df = spark.createDataFrame([(number,)], "x double")
    assert df.select(steady_round(F.col("x"), digits)).first()[0] == rounded


def test_steady_round_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),)], "x double")
    assert math.isnan(df.select(steady_round(F.col("x"), 2)).first()[0])
