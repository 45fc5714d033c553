"""The inputs of ``workload.inputs`` and their curated form, as DuckDB SQL.

Written independently of the library: other functions, other parsing rules
spelled out as patterns, rounding through decimals.
"""

RAW_CLICK = """
click_events AS (
  SELECT event_id AS e, user_id AS u, event_type AS kind, ts,
         CAST(value AS DECIMAL(18,2)) AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS k,
         CASE WHEN event_id % 19 = 0 THEN 't2' ELSE 't1' END AS student_id,
         CASE WHEN event_id % 29 = 0 THEN 'not-a-ts'
              WHEN event_id % 29 = 1 THEN '2024/01/05 10:00:00'
              WHEN event_id % 29 = 2 THEN NULL
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS "timestamp",
         CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 23 = 1 THEN '2024-1-5'
              ELSE strftime(ts, '%Y-%m-%d') END AS dt,
         ['/', '/events.html', '/event_detail.html', '/checkout.html', '/purchase_ok.html']
           [CAST(event_id % 5 + 1 AS INTEGER)] AS page,
         CASE WHEN event_id % 89 = 0 THEN NULL WHEN user_id % 10 < 4 THEN '10.9.0.1'
              WHEN user_id % 5 = 4 THEN '10.9.0.2' ELSE '10.0.0.' || (user_id % 16) END AS ip,
         'agent/' || (user_id % 4) AS user_agent,
         CASE WHEN user_id % 5 = 4 THEN 'sess_bot' ELSE 'sess_' || user_id END AS sess
  FROM events),
click_raw AS (
  SELECT student_id, "timestamp", dt, CASE WHEN e % 53 <> 0 THEN sess END AS session_id,
         CASE WHEN e % 59 = 0 THEN NULL ELSE CASE kind WHEN 'view' THEN 'view_event_list'
           WHEN 'click' THEN 'view_event_detail' WHEN 'signup' THEN 'begin_checkout'
           WHEN 'purchase' THEN 'purchase' ELSE 'click' END END AS event_type,
         CASE WHEN e % 61 <> 0 THEN 'client' END AS source, page,
         CAST(NULL AS VARCHAR) AS request_path, CAST(NULL AS VARCHAR) AS method,
         CAST(NULL AS VARCHAR) AS status_code, CAST(NULL AS VARCHAR) AS latency_ms,
         CASE WHEN kind NOT IN ('click', 'signup', 'purchase') THEN NULL WHEN e % 73 = 0 THEN 'abc'
              WHEN e % 79 = 0 THEN k || '.5' ELSE CAST(k AS VARCHAR) END AS event_id,
         CASE WHEN e % 3 = 0 THEN 'cmp_' || (u % 10) END AS utm_campaign,
         CASE WHEN kind <> 'purchase' THEN NULL WHEN e % 83 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS amount,
         ip, user_agent, CASE WHEN kind = 'error' THEN 'click' ELSE 'load' END AS action,
         CAST(NULL AS VARCHAR) AS element_id,
         CASE WHEN e % 4 = 0 THEN 'https://ref.example/' || (u % 3) END AS referrer,
         CAST(NULL AS VARCHAR) AS query, e AS e_event_id
  FROM click_events
  UNION ALL
  SELECT student_id, "timestamp", dt, CASE WHEN e % 7 <> 0 THEN sess END, 'server_request', 'server', page, page,
         CASE WHEN e % 3 = 0 THEN 'POST' ELSE 'GET' END,
         CASE WHEN e % 67 = 0 THEN 'ERR' WHEN e % 11 = 0 THEN '500' WHEN e % 13 = 0 THEN '404' ELSE '200' END,
         CASE WHEN e % 17 = 0 THEN NULL WHEN e % 71 = 0 THEN 'slow'
              WHEN u % 16 = 3 THEN CAST(price * 30 AS VARCHAR) ELSE CAST(price * 3 AS VARCHAR) END,
         NULL, NULL, NULL, ip, user_agent, NULL, NULL, NULL, '', e
  FROM click_events)"""

CLICK_TEXT = (
    'student_id, "timestamp", dt, session_id, event_type, source, page, request_path, method, status_code, '
    "latency_ms, event_id, utm_campaign, amount, ip, user_agent, action, element_id, referrer, query"
)


def _whole(column: str, dtype: str = "BIGINT") -> str:
    return (
        f"TRY_CAST(CASE WHEN regexp_full_match({column}, '\\s*[+-]?[0-9]+(\\.[0-9]*)?\\s*') "
        f"THEN regexp_extract({column}, '[+-]?[0-9]+') END AS {dtype})"
    )


def _instant(column: str) -> str:
    return (
        f"TRY_CAST(CASE WHEN regexp_matches({column}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T') "
        f"THEN {column} END AS TIMESTAMP)"
    )


def _day(dt: str, ts: str) -> str:
    return f"CASE WHEN length({dt}) = 10 THEN {dt} ELSE strftime({ts}, '%Y-%m-%d') END"


def curated_click(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT student_id, "timestamp", {_day('dt', 'event_ts')} AS dt, session_id,
           COALESCE(event_type, 'unknown') AS event_type, COALESCE(source, 'unknown') AS source, page,
           request_path, method, {_whole('status_code', 'INTEGER')} AS status_code,
           TRY_CAST(latency_ms AS DOUBLE) AS latency_ms, {_whole('event_id')} AS event_id, utm_campaign,
           TRY_CAST(amount AS DOUBLE) AS amount, ip, user_agent, action, element_id, referrer, query, event_ts
    FROM (SELECT *, {_instant('"timestamp"')} AS event_ts FROM {source}) WHERE student_id = 't1')
  WHERE dt IS NOT NULL)"""


COPIES = f"""
click_copies AS (
  SELECT {CLICK_TEXT} FROM click_raw
  UNION ALL SELECT {CLICK_TEXT} FROM click_raw WHERE e_event_id % 10 IN (0, 1)
  UNION ALL SELECT {CLICK_TEXT} FROM click_raw WHERE e_event_id % 10 = 1)"""

TX_RAW = """
tx_raw AS (
  SELECT CASE WHEN k % 41 <> 0 THEN 'tx_' || k END AS transaction_id,
         CASE WHEN k % 43 = 0 THEN 'not-a-ts' WHEN k % 43 = 1 THEN '2024/02/01 10:00:00' WHEN k % 43 = 2 THEN NULL
              ELSE day || 'T10:' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':00+00:00' END AS "timestamp",
         CASE WHEN k % 43 >= 4 THEN day END AS dt,
         CASE WHEN k % 53 = 0 THEN '  ' ELSE 'sess_' || (o_custkey % 150) END AS session_id,
         CASE WHEN k % 47 = 0 THEN '999999' WHEN k % 59 = 0 THEN 'x1' ELSE CAST(k % 100 + 1 AS VARCHAR) END AS event_id,
         CASE WHEN k % 61 = 0 THEN 'two' WHEN k % 61 = 1 THEN '1.0' ELSE CAST(k % 2 + 1 AS VARCHAR) END AS quantity,
         CASE WHEN k % 37 = 0 THEN NULL WHEN k % 37 = 1 THEN '-9.99' WHEN k % 37 = 2 THEN 'NaN'
              WHEN k % 37 = 3 THEN '9999999'
              ELSE (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS amount,
         CASE WHEN k % 31 = 0 THEN 'paypal' WHEN k % 31 = 1 THEN NULL
              ELSE ['card', 'bizum', 'transfer', 'cash'][CAST(left(o_orderpriority, 1) AS INTEGER) % 4 + 1]
              END AS payment_method,
         CASE WHEN k % 3 <> 0 THEN 'cmp_' || (o_custkey % 10) END AS utm_campaign,
         '2024-01-31T00:00:00+00:00' AS created_at
  FROM (SELECT *, o_orderkey AS k, CAST(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS VARCHAR) AS day,
               CAST(round(o_totalprice * 100) AS BIGINT) % 30000 + 100 AS cents FROM orders))"""

TX = f"""
tx AS (
  SELECT * FROM (
    SELECT transaction_id, "timestamp", {_day('dt', 'tx_ts')} AS dt, session_id, {_whole('event_id')} AS event_id,
           {_whole('quantity', 'INTEGER')} AS quantity, TRY_CAST(amount AS DOUBLE) AS amount, payment_method,
           utm_campaign, created_at, tx_ts
    FROM (SELECT *, {_instant('"timestamp"')} AS tx_ts FROM tx_raw))
  WHERE length(trim(transaction_id)) > 0 AND length(trim(session_id)) > 0 AND event_id IS NOT NULL
    AND amount > 0 AND amount < 5000 AND payment_method IN ('card', 'bizum', 'transfer', 'cash'))"""

CATALOG_RAW = """
catalog_raw AS (
  SELECT CASE WHEN p % 101 = 100 THEN 'none' ELSE CAST(p + 1 AS VARCHAR) END AS event_id,
         CASE WHEN p % 97 = 96 THEN ' ' ELSE p_name END AS name,
         CASE WHEN p % 23 <> 5 THEN p_brand END AS city, CASE WHEN p % 29 <> 7 THEN p_type END AS category,
         CASE WHEN p % 37 = 0 THEN '2026/04/10' WHEN p % 37 = 1 THEN '10-04-2026' WHEN p % 37 = 2 THEN 'not-a-date'
              ELSE CAST(DATE '2024-02-01' + CAST(p % 60 AS INTEGER) AS VARCHAR) END AS event_date,
         CASE WHEN p % 31 = 0 THEN 'free' WHEN p % 31 = 1 THEN '-12.5' WHEN p % 31 = 2 THEN '999999'
              ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS base_price,
         CASE WHEN p % 41 = 0 THEN 'one thousand' WHEN p % 41 = 1 THEN 'N/A' WHEN p % 41 = 2 THEN NULL
              ELSE CAST(p_size AS VARCHAR) END AS capacity,
         CASE WHEN p % 12 = 0 THEN '0' ELSE '1' END AS is_active,
         CASE WHEN p % 5 <> 0 THEN 'Show no. ' || p END AS description, '2024-01-01T00:00:00+00:00' AS created_at
  FROM (SELECT *, p_partkey AS p FROM part))"""

CATALOG = f"""
catalog AS (
  SELECT *, COALESCE(event_dt, 'unknown') AS dt FROM (
    SELECT {_whole('event_id')} AS event_id, name, city, category, event_date,
           TRY_CAST(base_price AS DOUBLE) AS base_price, {_whole('capacity')} AS capacity,
           {_whole('is_active', 'INTEGER')} AS is_active, description, created_at,
           CAST(TRY_CAST(CASE WHEN regexp_matches(event_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
                         THEN event_date END AS DATE) AS VARCHAR) AS event_dt
    FROM catalog_raw)
  WHERE event_id IS NOT NULL AND length(trim(name)) > 0 AND length(trim(city)) > 0
    AND length(trim(category)) > 0 AND base_price > 0 AND base_price < 1000)"""

CAMPAIGN_RAW = """
campaign_raw AS (
  SELECT CAST(s + 1 AS VARCHAR) AS campaign_id, CASE WHEN s % 13 <> 7 THEN 'cmp_' || (s % 50) END AS utm_campaign,
         CASE WHEN s % 7 = 6 THEN NULL WHEN s % 17 = 16 THEN 'radio'
              ELSE ['search', 'social', 'display', 'email', 'affiliate', 'direct'][CAST(s_nationkey % 6 + 1 AS INTEGER)]
              END AS channel,
         CASE WHEN s % 33 = 10 THEN '-50' WHEN s % 33 = 21 THEN 'unknown' WHEN s % 33 = 32 THEN '1000000'
              ELSE (s % 1900 + 80) || '.25' END AS monthly_cost,
         CASE WHEN s % 19 <> 3 THEN '2024-01-01' END AS start_dt, '2024-01-30' AS end_dt,
         '2024-01-01T00:00:00+00:00' AS created_at
  FROM (SELECT *, s_suppkey AS s FROM supplier))"""

CAMPAIGN = """
campaign AS (
  SELECT * FROM (
    SELECT campaign_id, utm_campaign, channel, TRY_CAST(monthly_cost AS DOUBLE) AS monthly_cost, start_dt, end_dt,
           created_at, COALESCE(start_dt, 'unknown') AS dt FROM campaign_raw)
  WHERE length(trim(utm_campaign)) > 0
    AND channel IN ('search', 'social', 'display', 'email', 'affiliate', 'direct')
    AND monthly_cost >= 0 AND monthly_cost < 100000)"""

# Each named set of rows with the sets it is built on.
SETS = {
    "click_raw": (RAW_CLICK, []),
    "click": (curated_click("click_raw", "click"), ["click_raw"]),
    "click_copies": (COPIES, ["click_raw"]),
    "tx_raw": (TX_RAW, []),
    "tx": (TX, ["tx_raw"]),
    "catalog_raw": (CATALOG_RAW, []),
    "catalog": (CATALOG, ["catalog_raw"]),
    "campaign_raw": (CAMPAIGN_RAW, []),
    "campaign": (CAMPAIGN, ["campaign_raw"]),
}


def with_sets(names: list[str], query: str) -> str:
    """``query`` preceded by the named sets and those they are built on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in SETS[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",".join(SETS[n][0] for n in ordered) + "\n" + query.strip()
