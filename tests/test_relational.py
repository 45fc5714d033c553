"""The relational sink up to the connection: no database runs in tests."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from gatetally import schemas as S
from gatetally.operators import funnel, interest, traffic
from gatetally.sources import relational as R


def test_decimals_become_doubles(spark):
    df = spark.createDataFrame([(1, Decimal("1.25"), "x")], "a int, b decimal(18,2), c string")
    assert R.to_sink_types(df).dtypes == [("a", "int"), ("b", "double"), ("c", "string")]
    assert R.to_sink_types(df.drop("b")).dtypes == [("a", "int"), ("c", "string")]


def test_tables_hold_the_metrics_without_their_partition_tag(clicks):
    df = clicks()
    frames = [
        (R.FUNNEL_TABLE, funnel.funnel_daily(df)),
        (R.RANK_TABLE, interest.event_rank(df)),
        (R.ANOMALY_TABLE, traffic.anomalies(df)),
    ]
    sql = {"date": "DATE", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR"}
    for table, frame in frames:
        got = R.sink_frame(frame, table).dtypes
        assert [n for n, _ in got] == list(table.columns)
        assert [sql[t] for _, t in got] == [t.split("(")[0] for t in table.columns.values()]


def test_days_become_dates_and_other_text_null(spark):
    rows = [("2024-01-05", 1, 1, 1, 1.0, 1.0), ("not-a-date", 1, 1, 1, 1.0, 1.0)]
    got = R.sink_frame(spark.createDataFrame(rows, S.RANK), R.RANK_TABLE).collect()
    assert [r["dt"] for r in got] == [dt.date(2024, 1, 5), None]


def test_definition_has_types_and_key():
    assert R.RANK_TABLE.ddl() == (
        "CREATE TABLE metrics_event_rank (dt DATE, event_id BIGINT, detail_views BIGINT, purchases BIGINT, "
        "revenue_total DOUBLE, interest_to_purchase_ratio DOUBLE, PRIMARY KEY (dt, event_id))"
    )
    assert R.FUNNEL_TABLE.column_types().startswith("dt DATE, sessions_total BIGINT")


def test_credentials_come_from_the_environment():
    assert R.connection_options({"METRICS_DB_USER": "u", "METRICS_DB_PASSWORD": "p"}) == {"user": "u", "password": "p"}
    with pytest.raises(KeyError):
        R.connection_options({})


def test_column_types_are_types_spark_knows(spark):
    for table in (R.FUNNEL_TABLE, R.RANK_TABLE, R.ANOMALY_TABLE):
        assert T.StructType.fromDDL(table.column_types()).fieldNames() == list(table.columns)


@pytest.mark.parametrize("keep", [True, False])
def test_writing_goes_as_far_as_the_driver(spark, keep):
    df = spark.createDataFrame([], S.RANK)
    with pytest.raises(Exception, match="No suitable driver"):
        R.write_jdbc(df, "jdbc:nothing://nowhere", R.RANK_TABLE, {"user": "u", "password": "p"}, keep)
