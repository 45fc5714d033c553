"""DuckDB SQL for each query in ``workload.queries``, over the same tables."""

from workload.inputs_sql import CLICK_TEXT, curated_click, with_sets

ORACLES: dict[str, str] = {}
STAMP = "%Y-%m-%d %H:%M:%S.%g"
CLICK_SHOWN = (
    'student_id, "timestamp", dt, session_id, event_type, source, page, request_path, method, status_code, '
    "latency_ms, event_id, utm_campaign, amount, ip, user_agent, action, element_id, referrer, query, "
    f"strftime(event_ts, '{STAMP}') AS event_ts"
)
TX_SHOWN = (
    'transaction_id, "timestamp", dt, session_id, event_id, quantity, amount, payment_method, utm_campaign, '
    f"created_at, strftime(tx_ts, '{STAMP}') AS tx_ts"
)


def _rounded(number: str, digits: int, snap: int = 9) -> str:
    return f"CAST(round(CAST({number} AS DECIMAL(38,{snap})), {digits}) AS DOUBLE)"


def _oracle(name: str, sets: list[str], sql: str) -> None:
    ORACLES[name] = with_sets(sets, sql)


# Sources and sinks
_oracle(
    "scan_jsonl",
    ["click_raw"],
    f"SELECT {CLICK_TEXT} FROM click_raw UNION ALL SELECT "
    + ", ".join(["NULL"] * 20)
    + " FROM events WHERE event_id % 97 = 0",
)
_oracle("scan_csv", ["tx_raw"], "SELECT * FROM tx_raw")
_oracle(
    "scan_partitioned", ["click"], "SELECT dt, session_id, event_id, amount FROM click WHERE event_type = 'purchase'"
)
_oracle("partition_roundtrip", ["tx"], f"SELECT {TX_SHOWN} FROM tx")
_oracle(
    "layer_counts",
    ["click", "catalog", "campaign", "tx"],
    """
SELECT 'clickstream' AS layer, count(*) AS n_rows FROM click UNION ALL SELECT 'events', count(*) FROM catalog
UNION ALL SELECT 'campaigns', count(*) FROM campaign UNION ALL SELECT 'transactions', count(*) FROM tx""",
)
_oracle(
    "catalog_active",
    ["catalog_raw"],
    """
SELECT TRY_CAST(event_id AS BIGINT) AS event_id, name, city, category, event_date,
       TRY_CAST(base_price AS DOUBLE) AS base_price, COALESCE(description, '') AS description
FROM catalog_raw
WHERE is_active = '1' AND trim(name) <> '' AND trim(city) <> '' AND trim(category) <> ''
  AND trim(event_date) <> '' AND TRY_CAST(base_price AS DOUBLE) IS NOT NULL""",
)
_oracle(
    "retention",
    ["click"],
    """
SELECT * FROM (
  SELECT CASE event_id WHEN 7 THEN '10-04-2024' WHEN 8 THEN '2023/12/01' ELSE dt END AS dt,
         session_id, event_type, source, event_id, ip FROM click)
WHERE dt BETWEEN '2024-01-11' AND '2024-01-25' OR dt IS NULL OR NOT regexp_full_match(dt, '[0-9]{4}-[0-9]{2}-[0-9]{2}')""",
)

# Projections, filters and casts
_oracle(
    "ensure_columns",
    ["click_raw"],
    """
SELECT student_id, "timestamp", dt, session_id, event_type, source, page, request_path, method, status_code,
       latency_ms, event_id, utm_campaign, ip, user_agent, action, CAST(NULL AS VARCHAR) AS element_id,
       CAST(NULL AS VARCHAR) AS query, CAST(NULL AS VARCHAR) AS amount, CAST(NULL AS VARCHAR) AS referrer
FROM click_raw""",
)
_oracle("tenant_filter", ["click_raw"], f"SELECT {CLICK_TEXT} FROM click_raw WHERE student_id = 't1'")
_oracle(
    "lenient_casts",
    ["click_raw"],
    r"""
SELECT TRY_CAST(regexp_extract(event_id, '^([0-9]+)(\.[0-9]*)?$', 1) AS BIGINT) AS event_id,
       TRY_CAST(status_code AS INTEGER) AS status_code, TRY_CAST(latency_ms AS DOUBLE) AS latency_ms,
       TRY_CAST(amount AS DOUBLE) AS amount
FROM click_raw""",
)
_oracle(
    "parse_ts",
    ["click_raw"],
    f"""
SELECT "timestamp", CASE WHEN "timestamp" LIKE '____-__-__T%Z'
         THEN strftime(CAST("timestamp" AS TIMESTAMP), '{STAMP}') END AS event_ts
FROM click_raw""",
)
_oracle(
    "repair_dt",
    ["tx_raw"],
    """
SELECT transaction_id, "timestamp", dt AS given_dt,
       CASE WHEN length(dt) = 10 THEN dt WHEN "timestamp" LIKE '____-__-__T%' THEN left("timestamp", 10) END AS dt
FROM tx_raw""",
)
_oracle(
    "catalog_dt",
    ["catalog_raw"],
    "SELECT event_date, CASE WHEN event_date LIKE '____-__-__' THEN event_date ELSE 'unknown' END AS dt"
    " FROM catalog_raw",
)
_oracle(
    "default_labels",
    ["click_raw"],
    "SELECT session_id, page, COALESCE(event_type, 'unknown') AS event_type, COALESCE(source, 'unknown') AS source"
    " FROM click_raw",
)
_oracle(
    "non_blank",
    ["tx_raw"],
    "SELECT transaction_id, session_id FROM tx_raw WHERE trim(transaction_id) <> '' AND trim(session_id) <> ''",
)
_oracle(
    "range_checks",
    ["catalog_raw", "campaign_raw", "tx_raw"],
    """
SELECT 'price' AS field, base_price AS given,
       TRY_CAST(base_price AS DOUBLE) > 0 AND TRY_CAST(base_price AS DOUBLE) < 1000 AS kept FROM catalog_raw
UNION ALL SELECT 'cost', monthly_cost,
       TRY_CAST(monthly_cost AS DOUBLE) >= 0 AND TRY_CAST(monthly_cost AS DOUBLE) < 100000 FROM campaign_raw
UNION ALL SELECT 'amount', amount,
       TRY_CAST(amount AS DOUBLE) > 0 AND TRY_CAST(amount AS DOUBLE) < 5000 FROM tx_raw""",
)
_oracle(
    "domain_checks",
    ["campaign_raw", "tx_raw"],
    """
SELECT 'channel' AS field, channel AS given,
       channel IN ('search', 'social', 'display', 'email', 'affiliate', 'direct') AS kept FROM campaign_raw
UNION ALL SELECT 'payment', payment_method, payment_method IN ('card', 'bizum', 'transfer', 'cash') FROM tx_raw""",
)
_oracle("curate_clickstream", ["click"], f"SELECT {CLICK_SHOWN} FROM click")
_oracle("curate_catalog", ["catalog"], "SELECT * FROM catalog")
_oracle("curate_campaigns", ["campaign"], "SELECT * FROM campaign")
_oracle("curate_transactions", ["tx"], f"SELECT {TX_SHOWN} FROM tx")
CLIENT = "(SELECT * FROM click WHERE source = 'client' AND session_id IS NOT NULL)"
SERVER = "(SELECT * FROM click WHERE event_type = 'server_request' AND ip IS NOT NULL)"
_oracle(
    "client_scope", ["click"], f"SELECT dt, session_id, event_type, event_id, utm_campaign, amount FROM {CLIENT}"
)
_oracle(
    "server_scope",
    ["click"],
    f"SELECT dt, ip, session_id, request_path, method, status_code, latency_ms FROM {SERVER}",
)
# The collector's view of the browser rows, from the same key remainders.
COLLECTED = """(
SELECT r.*, v.ts, CASE WHEN e_event_id % 9 = 0 THEN NULL WHEN e_event_id % 9 = 1 THEN ''
              WHEN e_event_id % 9 = 2 THEN ' 10.1.0.' || (v.u % 7) || ' , 172.16.0.1'
              ELSE '10.1.0.' || (v.u % 7) END AS forwarded_for,
       CASE WHEN e_event_id % 27 <> 0 THEN '192.168.0.9' END AS peer
FROM click_raw r JOIN click_events v ON v.e = r.e_event_id
WHERE r.event_type IS DISTINCT FROM 'server_request')"""
CLIENT_IP = """CASE WHEN forwarded_for <> '' THEN trim(split_part(forwarded_for, ',', 1))
                    ELSE COALESCE(peer, 'unknown') END"""
_oracle("client_ip", ["click_raw"], f"SELECT forwarded_for, peer, {CLIENT_IP} AS client_ip FROM {COLLECTED}")
STAMPED = """COALESCE("timestamp", strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')) AS "timestamp",
       COALESCE(dt, CASE WHEN "timestamp" LIKE '____-__-__T%' THEN left("timestamp", 10)
                         ELSE strftime(ts, '%Y-%m-%d') END) AS dt"""
_oracle(
    "stamped_rows",
    ["click_raw"],
    f"""
SELECT {STAMPED}, source, page, ip
FROM (SELECT r.*, v.ts FROM click_raw r JOIN click_events v ON v.e = r.e_event_id)""",
)
_oracle(
    "ingest_defaults",
    ["click_raw"],
    f"""
SELECT CASE WHEN e_event_id % 6 < 2 THEN 't9' ELSE student_id END AS student_id, {STAMPED},
       session_id, event_type, 'client' AS source,
       CASE e_event_id % 8 WHEN 0 THEN '/track' WHEN 1 THEN 'https://shop.example/' ELSE page END AS page,
       request_path, method, status_code, latency_ms, event_id, utm_campaign, amount, {CLIENT_IP} AS ip,
       user_agent, action, element_id, referrer, query
FROM {COLLECTED}""",
)

# Joins
_oracle(
    "tx_drop_orphans", ["tx", "catalog"], f"SELECT {TX_SHOWN} FROM tx WHERE event_id IN (SELECT event_id FROM catalog)"
)
_oracle(
    "tx_orphans",
    ["tx", "catalog"],
    "SELECT transaction_id, dt, session_id, event_id, amount FROM tx"
    " WHERE event_id NOT IN (SELECT event_id FROM catalog)",
)
RANK = f"""(
SELECT dt, event_id, detail_views, purchases, revenue_total,
       {_rounded('CAST(detail_views AS DOUBLE) / CASE WHEN purchases > 0 THEN purchases ELSE 1 END', 6, 15)}
         AS interest_to_purchase_ratio
FROM (SELECT COALESCE(v.dt, p.dt) AS dt, COALESCE(v.event_id, p.event_id) AS event_id,
             COALESCE(detail_views, 0) AS detail_views, COALESCE(purchases, 0) AS purchases,
             COALESCE(revenue_total, 0.0) AS revenue_total
      FROM (SELECT dt, event_id, count(*) AS detail_views FROM {CLIENT}
            WHERE event_type = 'view_event_detail' AND event_id IS NOT NULL GROUP BY ALL) v
      FULL JOIN (SELECT dt, event_id, count(*) AS purchases,
                        {_rounded('sum(COALESCE(amount, 0))', 2)} AS revenue_total FROM {CLIENT}
            WHERE event_type = 'purchase' AND event_id IS NOT NULL GROUP BY ALL) p
        ON v.dt = p.dt AND v.event_id = p.event_id))"""
_oracle("event_rank", ["click"], f"SELECT * FROM {RANK}")
_oracle("event_rank_joined", ["click"], f"SELECT * FROM {RANK}")
_oracle(
    "event_rank_top",
    ["click"],
    f"SELECT * FROM {RANK} ORDER BY dt, interest_to_purchase_ratio DESC, event_id LIMIT 1000",
)
_oracle("sink_types", ["click"], f"SELECT * FROM {RANK}")
FIRST_ENTRY = """(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY name, city, category, base_price) AS n FROM catalog)
  WHERE n = 1)"""
_oracle(
    "rank_with_catalog",
    ["click", "catalog"],
    f"SELECT r.*, c.name, c.city, c.category, c.base_price FROM {RANK} r LEFT JOIN {FIRST_ENTRY} c USING (event_id)",
)
_oracle(
    "clicks_with_catalog",
    ["click", "catalog"],
    f"""
SELECT r.dt, r.session_id, r.event_type, r.event_id, r.amount, c.name, c.city, c.category, c.base_price
FROM click r LEFT JOIN {FIRST_ENTRY} c USING (event_id)""",
)
_oracle(
    "campaign_roi",
    ["click", "campaign"],
    f"""
SELECT utm_campaign, events, purchases, revenue_total, monthly_cost,
       {_rounded('revenue_total - monthly_cost', 2)} AS net_revenue,
       {_rounded('revenue_total / NULLIF(monthly_cost, 0)', 6)} AS revenue_per_cost
FROM (SELECT utm_campaign, COALESCE(events, 0) AS events, COALESCE(purchases, 0) AS purchases,
             COALESCE(revenue_total, 0.0) AS revenue_total, monthly_cost
      FROM (SELECT utm_campaign, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
                   {_rounded("COALESCE(sum(amount) FILTER (event_type = 'purchase'), 0)", 2)} AS revenue_total
            FROM {CLIENT} WHERE utm_campaign IS NOT NULL GROUP BY utm_campaign)
      FULL JOIN (SELECT utm_campaign, {_rounded('sum(monthly_cost)', 2)} AS monthly_cost FROM campaign GROUP BY 1)
        USING (utm_campaign))""",
)
_oracle(
    "purchase_reconcile",
    ["click", "tx"],
    f"""
SELECT *, CASE WHEN tx_count = 0 THEN 'click_only' WHEN click_purchases = 0 THEN 'tx_only'
               WHEN tx_count <> click_purchases THEN 'count_differs'
               WHEN amount_difference <> 0 THEN 'amount_differs' ELSE 'matched' END AS status
FROM (SELECT *, {_rounded('click_amount - tx_amount', 2)} AS amount_difference
      FROM (SELECT session_id, event_id, sum(c)::BIGINT AS click_purchases, {_rounded('sum(ca)', 2)} AS click_amount,
                   sum(t)::BIGINT AS tx_count, {_rounded('sum(ta)', 2)} AS tx_amount
            FROM (SELECT session_id, event_id, 1 AS c, COALESCE(amount, 0) AS ca, 0 AS t, 0.0::DOUBLE AS ta FROM {CLIENT}
                  WHERE event_type = 'purchase' AND event_id IS NOT NULL
                  UNION ALL SELECT session_id, event_id, 0, 0, 1, amount FROM tx)
            GROUP BY session_id, event_id))""",
)

# Metrics
STEPS = {
    "event_list": "view_event_list",
    "event_detail": "view_event_detail",
    "begin_checkout": "begin_checkout",
    "purchase": "purchase",
}
FLAGS = ", ".join(f"max(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS has_{n}" for n, t in STEPS.items())
_oracle("session_flags", ["click"], f"SELECT dt, session_id, {FLAGS} FROM {CLIENT} GROUP BY dt, session_id")
COUNTS = ", ".join(
    f"count(DISTINCT CASE WHEN event_type = '{t}' THEN session_id END) AS sessions_{n}" for n, t in STEPS.items()
)
FUNNEL = f"""(
SELECT *, {_rounded('CAST(sessions_purchase AS DOUBLE) / sessions_total', 6, 15)} AS conversion_rate,
       'funnel' AS metric
FROM (SELECT dt, count(DISTINCT session_id) AS sessions_total, {COUNTS} FROM {CLIENT} GROUP BY dt))"""
_oracle("funnel_daily", ["click"], f"SELECT * FROM {FUNNEL} ORDER BY dt")
_oracle("sink_funnel", ["click"], f"SELECT * EXCLUDE (metric) FROM {FUNNEL}")
_oracle(
    "quality_checks",
    ["click"],
    f"""
SELECT check_name, count(*) AS days, count(*) FILTER (broken) AS violations FROM (
  SELECT 'purchase_le_checkout' AS check_name, sessions_purchase > sessions_begin_checkout AS broken FROM {FUNNEL}
  UNION ALL SELECT 'checkout_le_detail', sessions_begin_checkout > sessions_event_detail FROM {FUNNEL}
  UNION ALL SELECT 'detail_le_total', sessions_event_detail > sessions_total FROM {FUNNEL}
  UNION ALL SELECT 'rate_within_0_1', conversion_rate < 0 OR conversion_rate > 1 FROM {FUNNEL})
GROUP BY check_name""",
)
_oracle(
    "detail_views",
    ["click"],
    f"SELECT dt, event_id, count(*) AS detail_views FROM {CLIENT}"
    " WHERE event_type = 'view_event_detail' AND event_id IS NOT NULL GROUP BY ALL",
)
_oracle(
    "event_purchases",
    ["click"],
    f"SELECT dt, event_id, count(*) AS purchases, {_rounded('sum(COALESCE(amount, 0))', 2)} AS revenue_total"
    f" FROM {CLIENT} WHERE event_type = 'purchase' AND event_id IS NOT NULL GROUP BY ALL",
)


def _traffic(key: str, rows: str = SERVER, day: str = "dt") -> str:
    return f"""(
SELECT {day} AS dt, {key}, count(*) AS requests, count(*) FILTER (status_code >= 400) AS errors,
       CAST(0 AS BIGINT) AS purchases, count(DISTINCT session_id) AS sessions,
       {_rounded('avg(latency_ms)', 2)} AS avg_latency_ms, {_rounded('max(latency_ms)', 2)} AS max_latency_ms
FROM {rows} GROUP BY ALL)"""


def _flagged(traffic: str) -> str:
    return f"""(
SELECT *, requests >= 100 OR errors >= 5 OR avg_latency_ms >= 1000 OR (sessions <= 2 AND requests >= 50) AS is_anomaly,
       COALESCE(NULLIF(concat_ws(',', CASE WHEN requests >= 100 THEN 'high_requests' END,
         CASE WHEN errors >= 5 THEN 'many_errors' END, CASE WHEN avg_latency_ms >= 1000 THEN 'high_latency' END,
         CASE WHEN sessions <= 2 AND requests >= 50 THEN 'repetitive_ip' END), ''), 'normal') AS reason
FROM {traffic})"""


_oracle("ip_traffic", ["click"], f"SELECT * FROM {_traffic('ip')}")
_oracle("anomalies", ["click"], f"SELECT * FROM {_flagged(_traffic('ip'))} ORDER BY is_anomaly DESC, requests DESC")
_oracle(
    "anomalies_flagged",
    ["click"],
    f"SELECT * FROM {_flagged(_traffic('ip'))} WHERE is_anomaly ORDER BY requests DESC, dt, ip LIMIT 1000",
)
_oracle(
    "sink_anomalies",
    ["click"],
    f"SELECT * FROM {_flagged(_traffic('ip'))} WHERE is_anomaly",
)
_oracle(
    "metric_counts",
    ["click"],
    f"""
SELECT 'metrics_funnel_daily' AS layer, count(*) AS n_rows FROM {FUNNEL}
UNION ALL SELECT 'metrics_event_rank', count(*) FROM {RANK}
UNION ALL SELECT 'metrics_anomalies', count(*) FROM {_traffic('ip')}""",
)
_oracle("endpoint_anomalies", ["click"], f"SELECT * FROM {_flagged(_traffic('request_path'))}")
_oracle("dedup_clickstream", ["click_copies"], f"SELECT DISTINCT {CLICK_TEXT} FROM click_copies")
DISTINCT_COPIES = (
    with_sets(["click_copies"], "").rstrip()
    + f",\nclick_once AS (SELECT DISTINCT {CLICK_TEXT} FROM click_copies),"
    + curated_click("click_once", "click")
)
ORACLES["curate_clickstream_strict"] = f"{DISTINCT_COPIES}\nSELECT {CLICK_SHOWN} FROM click"
_oracle(
    "session_attribution",
    ["click"],
    f"""
SELECT session_id, strftime(event_ts, '{STAMP}') AS event_ts, event_type, event_id,
       COALESCE(substr(max(CASE WHEN utm_campaign IS NOT NULL AND event_ts IS NOT NULL
         THEN strftime(event_ts, '{STAMP}') || utm_campaign END) OVER upto, 24), utm_campaign) AS attr_campaign,
       COALESCE(substr(min(CASE WHEN referrer IS NOT NULL AND event_ts IS NOT NULL
         THEN strftime(event_ts, '{STAMP}') || referrer END) OVER upto, 24), referrer) AS attr_referrer,
       strftime(min(CASE WHEN utm_campaign IS NOT NULL THEN event_ts END) OVER upto, '{STAMP}') AS first_seen_ts
FROM {CLIENT}
WINDOW upto AS (PARTITION BY session_id ORDER BY event_ts NULLS FIRST
                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)

# Log queries
KINDS = "'view_event_list', 'view_event_detail', 'begin_checkout', 'purchase'"
_oracle(
    "q1_funnel_daily",
    ["click"],
    "SELECT dt, event_type, count(DISTINCT session_id) AS sessions FROM click"
    f" WHERE source = 'client' AND event_type IN ({KINDS}) GROUP BY ALL ORDER BY dt, event_type",
)
_oracle(
    "q2_interest_revenue",
    ["click"],
    f"SELECT dt, event_id, event_type, count(*) AS events, {_rounded('sum(amount)', 6)} AS revenue_total FROM click"
    " WHERE source = 'client' AND event_id IS NOT NULL AND event_type IN ('view_event_detail', 'purchase')"
    " GROUP BY ALL ORDER BY dt, events DESC",
)


def _health(keys: str, rows: str) -> str:
    return f"""
SELECT {keys}, count(*) AS requests, {_rounded('avg(latency_ms)', 6)} AS avg_latency_ms,
       min(CASE WHEN nth >= ceil(timed * 0.95::DECIMAL(3,2)) THEN latency_ms END) AS p95_latency_ms,
       max(status_code) AS max_status
FROM (SELECT *, count(latency_ms) OVER (PARTITION BY {keys}) AS timed,
             CASE WHEN latency_ms IS NOT NULL
                  THEN row_number() OVER (PARTITION BY {keys} ORDER BY latency_ms NULLS LAST) END AS nth
      FROM (SELECT *, strftime(date_trunc('hour', event_ts), '{STAMP}') AS hour FROM click
            WHERE event_type = 'server_request' {rows}))
GROUP BY {keys}"""


_oracle("q3_endpoint_hourly", ["click"], _health("hour, request_path", ""))
_oracle("q3_endpoint", ["click"], _health("request_path", ""))
_oracle(
    "q4_suspected_bots",
    ["click"],
    f"""
SELECT dt, ip, requests, sessions, {_rounded('avg_latency_ms', 6)} AS avg_latency_ms
FROM (SELECT dt, ip, count(*) AS requests, count(DISTINCT session_id) AS sessions, avg(latency_ms) AS avg_latency_ms
      FROM click WHERE event_type = 'server_request' GROUP BY dt, ip)
WHERE requests > 100 OR (sessions <= 2 AND requests > 50) OR avg_latency_ms > 1000""",
)

# Streams: all files arrive in one batch, so no row is late. Windows that end
# after the watermark are still open and not in the output yet.
_oracle("stream_curation", ["click"], f"SELECT {CLICK_SHOWN} FROM click")
CLOSED = "(SELECT max(event_ts) - INTERVAL 10 MINUTE FROM click WHERE event_type = 'server_request'{})"
_oracle(
    "stream_endpoint_hourly",
    ["click"],
    _health(
        "hour, request_path",
        f"AND date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= {CLOSED.format('')}",
    ),
)
TIMED = "(SELECT * FROM click WHERE event_type = 'server_request' AND ip IS NOT NULL AND event_ts IS NOT NULL{})"
DAY = "strftime(event_ts, '%Y-%m-%d')"
_oracle(
    "stream_ip_anomalies_closed",
    ["click"],
    "SELECT * FROM "
    + _flagged(
        _traffic(
            "ip",
            TIMED.format(
                " AND date_trunc('day', event_ts) + INTERVAL 1 DAY <= " + CLOSED.format(" AND ip IS NOT NULL")
            ),
            DAY,
        )
    ),
)
LIVE = _flagged(_traffic("ip", TIMED.format(""), DAY))
# The sketched session counts are exact for the number of sessions there is per day and address.
_oracle("stream_ip_anomalies_sketched", ["click"], f"SELECT * FROM {LIVE}")
# Stored sums equal the batch metric: late rows and rows without a time count.
for _name in ("stream_ip_anomalies", "stream_metric_upsert"):
    ORACLES[_name] = ORACLES["anomalies"]
ORACLES["stream_endpoint_hourly_stored"] = ORACLES["q3_endpoint_hourly"]
ORACLES["stream_dedup"] = f"{DISTINCT_COPIES}\nSELECT {CLICK_SHOWN} FROM click"
ORACLES["stream_tail"] = ORACLES["scan_jsonl"]
ORACLES["stream_attribution"] = ORACLES["session_attribution"]
_oracle(
    "stream_endpoint_percentiles",
    ["click"],
    f"""
SELECT request_path, count(*) AS requests, {_rounded('avg(latency_ms)', 6)} AS avg_latency_ms,
       max(status_code) AS max_status, TRUE AS p95_near
FROM click WHERE event_type = 'server_request' AND request_path IS NOT NULL GROUP BY request_path""",
)

# Days replaced, open fields, campaign periods
ODD = "substr(dt, 10, 1) IN ('1', '3', '5', '7', '9')"
FAILED = f"(SELECT * FROM click WHERE event_type = 'server_request' AND ip IS NOT NULL AND status_code >= 500 AND {ODD})"
_oracle(
    "days_replaced",
    ["click"],
    f"SELECT * FROM {_flagged(_traffic('ip'))} WHERE ({ODD}) IS NOT TRUE"
    f" UNION ALL SELECT * FROM {_flagged(_traffic('ip', FAILED))}",
)
_oracle(
    "open_fields_curated",
    ["click"],
    """
SELECT dt, session_id, event_type,
       CASE WHEN referrer IS NOT NULL THEN '{"plan":{"tier":' || length(page) || '},"score":'
         || length(COALESCE(ip, '')) || '}' END AS extra,
       CASE WHEN referrer IS NOT NULL THEN length(page)::INT END AS tier,
       CASE WHEN referrer IS NOT NULL THEN length(COALESCE(ip, ''))::INT END AS score
FROM click""",
)
ORACLES["malformed_lines"] = (
    """SELECT '{"student_id": "t1", "page": "' || event_id AS malformed FROM events WHERE event_id % 97 = 0"""
)
_oracle(
    "campaign_periods",
    ["click", "campaign"],
    f"""
SELECT campaign_id, utm_campaign, channel, active_from::VARCHAR AS active_from, active_to::VARCHAR AS active_to, cost,
       count(day) AS events, count(*) FILTER (event_type = 'purchase') AS purchases, revenue_total,
       {_rounded('revenue_total - cost', 2)} AS net_revenue, {_rounded('revenue_total / NULLIF(cost, 0)', 6)} AS revenue_per_cost
FROM (
  SELECT *, {_rounded("COALESCE(sum(amount) FILTER (event_type = 'purchase') OVER "
                      "(PARTITION BY campaign_id, utm_campaign, channel, active_from, active_to, cost), 0)", 2)} AS revenue_total
  FROM (
    SELECT p.*, (SELECT {_rounded('sum(p.monthly_cost / day(last_day(d)))', 2)}
                 FROM (SELECT unnest(generate_series(p.active_from, p.active_to, INTERVAL 1 DAY)) AS d)) AS cost
    FROM (
      SELECT DISTINCT campaign_id, utm_campaign, channel, monthly_cost,
             greatest(COALESCE(start_day, DATE '2024-01-03'), DATE '2024-01-03') AS active_from,
             least(COALESCE(end_day, DATE '2024-02-15'), DATE '2024-02-15') AS active_to
      FROM (SELECT *, CASE WHEN campaign_id::INT % 4 <> 0 THEN DATE '2024-01-01' + campaign_id::INT % 20 END AS start_day,
                   CASE WHEN campaign_id::INT % 5 <> 0 AND campaign_id::INT % 6 <> 0
                        THEN DATE '2024-01-10' + campaign_id::INT % 30 END AS end_day FROM campaign)) AS p
    WHERE active_from <= active_to) AS c
  LEFT JOIN (SELECT utm_campaign AS key, TRY_CAST(dt AS DATE) AS day, event_type, amount FROM {CLIENT}) AS e
    ON e.key = c.utm_campaign AND e.day BETWEEN c.active_from AND c.active_to)
GROUP BY ALL""",
)
