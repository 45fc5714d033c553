"""Raw text rows to typed, checked rows. Narrow transforms: no shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatetally import schemas as S
from gatetally.functions import cells as C


def with_missing(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Add each contract column that ``df`` lacks as a null of its type."""
    have = set(df.columns)
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in contract if f.name not in have]
    return df.select("*", *absent) if absent else df


def of_tenant(df: DataFrame, tenant: str) -> DataFrame:
    return df.filter(F.col("student_id") == tenant)


def curate_clickstream(raw: DataFrame, tenant: str) -> DataFrame:
    """One tenant's events with types, day key and labels settled."""
    ts = C.instant(F.col("timestamp"))
    settled = {
        "event_ts": ts,
        "dt": C.settled_day(F.col("dt"), ts),
        "event_type": C.or_unknown(F.col("event_type")),
        "source": C.or_unknown(F.col("source")),
        "event_id": C.whole_number(F.col("event_id")),
        "amount": C.real_number(F.col("amount")),
        "status_code": C.whole_number(F.col("status_code"), "int"),
        "latency_ms": C.real_number(F.col("latency_ms")),
    }
    rows = of_tenant(with_missing(raw, S.CLICK_RAW), tenant)
    return rows.withColumns(settled).filter(F.col("dt").isNotNull())


def curate_catalog(raw: DataFrame) -> DataFrame:
    """Events on sale with a name, a place, a category and a plausible price."""
    event_dt = C.day_text(F.col("event_date"))
    typed = raw.withColumns(
        {
            "event_id": C.whole_number(F.col("event_id")),
            "base_price": C.real_number(F.col("base_price")),
            "capacity": C.whole_number(F.col("capacity")),
            "is_active": C.whole_number(F.col("is_active"), "int"),
            "event_dt": event_dt,
            "dt": C.or_unknown(event_dt),
        }
    )
    return typed.filter(
        F.col("event_id").isNotNull()
        & C.filled(F.col("name"))
        & C.filled(F.col("city"))
        & C.filled(F.col("category"))
        & C.between_open(F.col("base_price"), *S.PRICE_RANGE)
    )


def curate_campaigns(raw: DataFrame) -> DataFrame:
    """Campaigns with a key, a known channel and a plausible monthly cost."""
    typed = raw.withColumns(
        {
            "monthly_cost": C.real_number(F.col("monthly_cost")),
            "dt": C.or_unknown(F.col("start_dt")),
        }
    )
    return typed.filter(
        C.filled(F.col("utm_campaign"))
        & C.one_of(F.col("channel"), S.CHANNELS)
        & C.from_up_to(F.col("monthly_cost"), *S.COST_RANGE)
    )


def curate_transactions(raw: DataFrame) -> DataFrame:
    """Sales with keys, a plausible amount and a known payment method.

    A sale whose day cannot be told keeps a null ``dt``. Sales of events that
    are not in the catalog stay too; see :func:`operators.joins.known_events`.
    """
    ts = C.instant(F.col("timestamp"))
    typed = raw.withColumns(
        {
            "event_id": C.whole_number(F.col("event_id")),
            "quantity": C.whole_number(F.col("quantity"), "int"),
            "amount": C.real_number(F.col("amount")),
            "tx_ts": ts,
            "dt": C.settled_day(F.col("dt"), ts),
        }
    )
    return typed.filter(
        C.filled(F.col("transaction_id"))
        & C.filled(F.col("session_id"))
        & F.col("event_id").isNotNull()
        & C.between_open(F.col("amount"), *S.AMOUNT_RANGE)
        & C.one_of(F.col("payment_method"), S.PAYMENT_METHODS)
    )


def distinct_rows(df: DataFrame, contract: T.StructType = S.CLICK_RAW) -> DataFrame:
    """One of each set of rows that agree in every contract column.

    Written as a grouping, so copies collapse before the shuffle and a row
    repeated in a third of the data sends one row per task.
    """
    return df.dropDuplicates([f.name for f in contract if f.name in df.columns])


def curate_clickstream_strict(raw: DataFrame, tenant: str) -> DataFrame:
    """Curation with the documented removal of copies, done on the raw text."""
    return curate_clickstream(distinct_rows(of_tenant(with_missing(raw, S.CLICK_RAW), tenant)), tenant)


def client_events(df: DataFrame) -> DataFrame:
    """Browser events that belong to a session."""
    return df.filter((F.col("source") == "client") & F.col("session_id").isNotNull())


def server_requests(df: DataFrame) -> DataFrame:
    """Requests logged by the server with a client address."""
    return df.filter((F.col("event_type") == "server_request") & F.col("ip").isNotNull())


def retained(df: DataFrame, days: int, as_of: str) -> DataFrame:
    """Rows of the last ``days`` days up to and including ``as_of`` (``YYYY-MM-DD``).

    Both bounds are literals on the partition key, so other folders are not
    read. The age of a row whose key is missing or no ISO date cannot be told:
    such rows are kept.
    """
    first = F.date_sub(F.lit(as_of).cast("date"), days).cast("string")
    dated = F.coalesce(F.col("dt").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    return df.filter((F.col("dt") >= first) & (F.col("dt") <= as_of) | ~dated)


def web_catalog(raw: DataFrame) -> DataFrame:
    """Rows of the raw catalog that may be shown on the web site.

    Only a parsable price is asked for; a negative or very high one passes.
    """
    shown = raw.filter(
        (F.col("is_active") == "1")
        & C.filled(F.col("name"))
        & C.filled(F.col("city"))
        & C.filled(F.col("category"))
        & C.filled(F.col("event_date"))
        & C.is_float_text(F.col("base_price"))
    )
    return shown.select(
        C.whole_number(F.col("event_id")).alias("event_id"),
        "name",
        "city",
        "category",
        "event_date",
        C.real_number(F.col("base_price")).alias("base_price"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"),
    )


def stamped(rows: DataFrame) -> DataFrame:
    """Fill a missing time and day from ``ingest_ts``, the time of receipt.

    The day is the one written in the row's own ISO time, whatever its offset,
    else the day of receipt.
    """
    stamp = F.coalesce(
        C.given(F.col("timestamp")),
        F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
    )
    iso = stamp.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$") & C.instant(stamp).isNotNull()
    own_day = F.when(iso, F.substring(stamp, 1, 10)).otherwise(F.to_date("ingest_ts").cast("string"))
    return rows.withColumns({"timestamp": stamp, "dt": F.coalesce(C.given(F.col("dt")), own_day)})


def ingest_defaults(rows: DataFrame, tenant: str) -> DataFrame:
    """Fill what a collected browser event lacks.

    Besides the contract, ``rows`` has ``ingest_ts`` and the request's
    ``forwarded_for``, ``peer``, ``agent``, ``referer`` and ``path``, which give
    the address, the user agent and the page where the event has none.
    """
    filled = {
        "student_id": F.coalesce(C.given(F.col("student_id")), F.lit(tenant)),
        "source": F.lit("client"),
        "page": F.coalesce(C.given(F.col("page")), C.given(F.col("referer")), F.col("path")),
        "ip": F.coalesce(F.col("ip"), C.first_forwarded(F.col("forwarded_for"), F.col("peer"))),
        "user_agent": F.coalesce(F.col("user_agent"), F.col("agent")),
    }
    return stamped(rows).withColumns(filled).select(*S.CLICK_RAW.fieldNames())
