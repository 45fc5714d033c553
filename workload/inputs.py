"""Raw inputs derived from the driver's tables.

``events`` gives a clickstream with one browser row and one server row per
event, ``orders`` the sales, ``part`` the catalog and ``supplier`` the
campaigns. Faults are placed by integer remainders of the row's key, so that
``workload.inputs_sql`` can derive the same text in SQL. Every row of each
table is used. All columns are text, as in the files the library reads.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatetally import schemas as S

TENANT = "t1"
# The fault texts of the input files ("10-04-2026", "2026/04/10", "not-a-date", "one thousand",
# "N/A", "free", "999999", "9999999", "-9.99", "paypal") stand where they are placed below.
# Fixed value: the pages of the web site.
PAGES = ("/", "/events.html", "/event_detail.html", "/checkout.html", "/purchase_ok.html")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _case(*branches, other=None) -> Column:
    """First matching branch's value; texts are literals, None is null."""
    def value(v):
        return v if isinstance(v, Column) else F.lit(v).cast("string")

    out = None
    for cond, v in branches:
        out = F.when(cond, value(v)) if out is None else out.when(cond, value(v))
    return out.otherwise(value(other))


def _contract(columns: dict[str, Column], schema) -> list[Column]:
    return [columns.get(f.name, F.lit(None).cast("string")).cast("string").alias(f.name) for f in schema]


def clickstream(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Browser and server rows of every event. ``keep`` names event columns to carry along."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    e, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    price = F.col("value").cast("decimal(18,2)")
    k = F.get_json_object("props", "$.k").cast("bigint") + 1
    both = {
        "student_id": _case((e % 19 == 0, "t2"), other=TENANT),
        "timestamp": _case(
            (e % 29 == 0, "not-a-ts"),
            (e % 29 == 1, "2024/01/05 10:00:00"),
            (e % 29 == 2, None),
            other=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        ),
        "dt": _case((e % 23 == 0, None), (e % 23 == 1, "2024-1-5"), other=F.date_format("ts", "yyyy-MM-dd")),
        "page": _pick(e % 5, PAGES),
        "ip": _case(
            (e % 89 == 0, None),
            (u % 10 < 4, "10.9.0.1"),
            (u % 5 == 4, "10.9.0.2"),
            other=_text("10.0.0.", u % 16),
        ),
        "user_agent": _text("agent/", u % 4),
    }
    session = _case((u % 5 == 4, "sess_bot"), other=_text("sess_", u))
    browser = both | {
        "session_id": _case((e % 53 == 0, None), other=session),
        "event_type": _case(
            (e % 59 == 0, None),
            (kind == "view", "view_event_list"),
            (kind == "click", "view_event_detail"),
            (kind == "signup", "begin_checkout"),
            (kind == "purchase", "purchase"),
            other="click",
        ),
        "source": _case((e % 61 == 0, None), other="client"),
        "event_id": _case(
            (~kind.isin("click", "signup", "purchase"), None),
            (e % 73 == 0, "abc"),
            (e % 79 == 0, _text(k, ".5")),
            other=k.cast("string"),
        ),
        "utm_campaign": _case((e % 3 == 0, _text("cmp_", u % 10))),
        "amount": _case((kind != "purchase", None), (e % 83 == 0, "n/a"), other=price.cast("string")),
        "action": _case((kind == "error", "click"), other="load"),
        "referrer": _case((e % 4 == 0, _text("https://ref.example/", u % 3))),
    }
    server = both | {
        "session_id": _case((e % 7 == 0, None), other=session),
        "event_type": F.lit("server_request"),
        "source": F.lit("server"),
        "request_path": both["page"],
        "method": _case((e % 3 == 0, "POST"), other="GET"),
        "status_code": _case((e % 67 == 0, "ERR"), (e % 11 == 0, "500"), (e % 13 == 0, "404"), other="200"),
        "latency_ms": _case(
            (e % 17 == 0, None),
            (e % 71 == 0, "slow"),
            (u % 16 == 3, (price * 30).cast("string")),
            other=(price * 3).cast("string"),
        ),
        "query": F.lit(""),
    }
    carried = [F.col(c).alias(f"e_{c}") for c in keep]
    return events.select(*_contract(browser, S.CLICK_RAW), *carried).unionByName(
        events.select(*_contract(server, S.CLICK_RAW), *carried)
    )


def clickstream_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream with every row of some events logged once or twice more."""
    rows = clickstream(spark, sf_dir, keep=("event_id",))
    times = F.when(F.col("e_event_id") % 10 == 0, 2).when(F.col("e_event_id") % 10 == 1, 3).otherwise(1)
    return rows.withColumn("_n", F.explode(F.array_repeat(F.lit(1), times))).drop("_n", "e_event_id")


def collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Browser rows as a collector receives them, with the request's headers."""
    rows = clickstream(spark, sf_dir, keep=("event_id", "ts", "user_id")).filter(
        ~F.col("event_type").eqNullSafe(F.lit("server_request"))
    )
    e, u = F.col("e_event_id"), F.col("e_user_id")
    return rows.withColumns(
        {
            "student_id": _case((e % 6 == 0, None), (e % 6 == 1, ""), other=F.col("student_id")),
            "page": _case((e % 8 < 2, None), other=F.col("page")),
            "ip": F.lit(None).cast("string"),
            "user_agent": F.lit(None).cast("string"),
            "ingest_ts": F.col("e_ts"),
            "forwarded_for": _case(
                (e % 9 == 0, None),
                (e % 9 == 1, ""),
                (e % 9 == 2, _text(" 10.1.0.", u % 7, " , 172.16.0.1")),
                other=_text("10.1.0.", u % 7),
            ),
            "peer": _case((e % 27 == 0, None), other="192.168.0.9"),
            "agent": _text("agent/", u % 4),
            "referer": _case((e % 8 == 0, None), other="https://shop.example/"),
            "path": F.lit("/track"),
        }
    ).drop("e_event_id", "e_ts", "e_user_id")


def _day_after(first: str, days: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), days.cast("int")).cast("string")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    day = _day_after("2024-01-01", k % 30)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") % 30000 + 100
    euros = _text(F.floor(cents / 100), ".", F.lpad((cents % 100).cast("string"), 2, "0"))
    columns = {
        "transaction_id": _case((k % 41 == 0, None), other=_text("tx_", k)),
        "timestamp": _case(
            (k % 43 == 0, "not-a-ts"),
            (k % 43 == 1, "2024/02/01 10:00:00"),
            (k % 43 == 2, None),
            other=_text(day, "T10:", F.lpad((k % 60).cast("string"), 2, "0"), ":00+00:00"),
        ),
        "dt": _case((k % 43 < 4, None), other=day),
        "session_id": _case((k % 53 == 0, "  "), other=_text("sess_", c % 150)),
        "event_id": _case((k % 47 == 0, "999999"), (k % 59 == 0, "x1"), other=(k % 100 + 1).cast("string")),
        "quantity": _case((k % 61 == 0, "two"), (k % 61 == 1, "1.0"), other=(k % 2 + 1).cast("string")),
        "amount": _case(
            (k % 37 == 0, None),
            (k % 37 == 1, "-9.99"),
            (k % 37 == 2, "NaN"),
            (k % 37 == 3, "9999999"),
            other=euros,
        ),
        "payment_method": _case(
            (k % 31 == 0, "paypal"),
            (k % 31 == 1, None),
            other=_pick(F.substring("o_orderpriority", 1, 1).cast("bigint") % 4, S.PAYMENT_METHODS),
        ),
        "utm_campaign": _case((k % 3 == 0, None), other=_text("cmp_", c % 10)),
        "created_at": F.lit("2024-01-31T00:00:00+00:00"),
    }
    return orders.select(*_contract(columns, S.TX_RAW))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    p = F.col("p_partkey")
    columns = {
        "event_id": _case((p % 101 == 100, "none"), other=(p + 1).cast("string")),
        "name": _case((p % 97 == 96, " "), other=F.col("p_name")),
        "city": _case((p % 23 == 5, None), other=F.col("p_brand")),
        "category": _case((p % 29 == 7, None), other=F.col("p_type")),
        "event_date": _case(
            (p % 37 == 0, "2026/04/10"),
            (p % 37 == 1, "10-04-2026"),
            (p % 37 == 2, "not-a-date"),
            other=_day_after("2024-02-01", p % 60),
        ),
        "base_price": _case(
            (p % 31 == 0, "free"),
            (p % 31 == 1, "-12.5"),
            (p % 31 == 2, "999999"),
            other=F.col("p_retailprice").cast("decimal(18,2)").cast("string"),
        ),
        "capacity": _case(
            (p % 41 == 0, "one thousand"), (p % 41 == 1, "N/A"), (p % 41 == 2, None), other=F.col("p_size").cast("string")
        ),
        "is_active": _case((p % 12 == 0, "0"), other="1"),
        "description": _case((p % 5 == 0, None), other=_text("Show no. ", p)),
        "created_at": F.lit("2024-01-01T00:00:00+00:00"),
    }
    return part.select(*_contract(columns, S.CATALOG_RAW))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    s = F.col("s_suppkey")
    columns = {
        "campaign_id": (s + 1).cast("string"),
        "utm_campaign": _case((s % 13 == 7, None), other=_text("cmp_", s % 50)),
        "channel": _case((s % 7 == 6, None), (s % 17 == 16, "radio"), other=_pick(F.col("s_nationkey") % 6, S.CHANNELS)),
        "monthly_cost": _case(
            (s % 33 == 10, "-50"), (s % 33 == 21, "unknown"), (s % 33 == 32, "1000000"), other=_text(s % 1900 + 80, ".25")
        ),
        "start_dt": _case((s % 19 == 3, None), other="2024-01-01"),
        "end_dt": F.lit("2024-01-30"),
        "created_at": F.lit("2024-01-01T00:00:00+00:00"),
    }
    return supplier.select(*_contract(columns, S.CAMPAIGN_RAW))
