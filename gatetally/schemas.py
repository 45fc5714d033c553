"""Column contracts of the raw, curated and analytics layers.

Raw columns are all text: reading them needs no schema inference, and every
cast is made explicitly during curation.
"""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _fields(spec: str) -> T.StructType:
    """Schema of ``name type`` pairs; needs no session, unlike ``fromDDL``."""
    pairs = [pair.split() for pair in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _text(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Field names and value domains of the input files.
CLICK_RAW = _text(
    "student_id timestamp dt session_id event_type source page request_path "
    "method status_code latency_ms event_id utm_campaign amount ip user_agent "
    "action element_id referrer query"
)
CATALOG_RAW = _text(
    "event_id name city category event_date base_price capacity is_active "
    "description created_at"
)
CAMPAIGN_RAW = _text(
    "campaign_id utm_campaign channel monthly_cost start_dt end_dt created_at"
)
TX_RAW = _text(
    "transaction_id timestamp dt session_id event_id quantity amount "
    "payment_method utm_campaign created_at"
)
PAYMENT_METHODS = ("card", "bizum", "transfer", "cash")
CHANNELS = ("search", "social", "display", "email", "affiliate", "direct")
# Ranges that prices, monthly costs and sale amounts must be in.
PRICE_RANGE = (0, 1000)
COST_RANGE = (0, 100000)
AMOUNT_RANGE = (0, 5000)
# Funnel step event types, and the names of their columns in the funnel metric.
FUNNEL_STEPS = {
    "view_event_list": "event_list",
    "view_event_detail": "event_detail",
    "begin_checkout": "begin_checkout",
    "purchase": "purchase",
}

CLICK_CURATED = _fields(
    "student_id string, timestamp string, dt string, session_id string, "
    "event_type string, source string, page string, request_path string, "
    "method string, status_code int, latency_ms double, event_id bigint, "
    "utm_campaign string, amount double, ip string, user_agent string, "
    "action string, element_id string, referrer string, query string, "
    "event_ts timestamp"
)
CATALOG_CURATED = _fields(
    "event_id bigint, name string, city string, category string, "
    "event_date string, base_price double, capacity bigint, is_active int, "
    "description string, created_at string, event_dt string, dt string"
)
CAMPAIGN_CURATED = _fields(
    "campaign_id string, utm_campaign string, channel string, "
    "monthly_cost double, start_dt string, end_dt string, created_at string, "
    "dt string"
)
TX_CURATED = _fields(
    "transaction_id string, timestamp string, dt string, session_id string, "
    "event_id bigint, quantity int, amount double, payment_method string, "
    "utm_campaign string, created_at string, tx_ts timestamp"
)
FUNNEL = _fields(
    "dt string, sessions_total bigint, sessions_event_list bigint, "
    "sessions_event_detail bigint, sessions_begin_checkout bigint, "
    "sessions_purchase bigint, conversion_rate double, metric string"
)
RANK = _fields(
    "dt string, event_id bigint, detail_views bigint, purchases bigint, "
    "revenue_total double, interest_to_purchase_ratio double"
)
ANOMALY = _fields(
    "dt string, ip string, requests bigint, errors bigint, purchases bigint, "
    "sessions bigint, avg_latency_ms double, max_latency_ms double, "
    "is_anomaly boolean, reason string"
)

# Partition columns of each stored layer. The rank metric is partitioned by day
# only: a directory per event and day would mean one tiny file per row.
LAYER_KEYS = {
    "clickstream": ("dt", "event_type"),
    "events": ("dt", "category"),
    "campaigns": ("dt", "channel"),
    "transactions": ("dt", "payment_method"),
    "metrics_funnel_daily": ("dt", "metric"),
    "metrics_event_rank": ("dt",),
    "metrics_anomalies": ("dt", "is_anomaly"),
}
