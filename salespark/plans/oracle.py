"""Independent SQL (DuckDB dialect) for the correctness check.

Each oracle starts from the supplied ``lineitem`` view and derives the same
``sales_events`` rows as ``salespark.sources.fixture``, then classifies,
deduplicates and aggregates with plain SQL.  It never parses the JSON texts: it knows of each event what it
holds, so parsing is checked against that knowledge.
"""

from __future__ import annotations

# Derivation rules of the fixture (FIXTURES.md section 2).  has_*: the key is present; qty: the number a
# reader of the field gets, if any; qty_number: it is a JSON number; its: the clock on the event's text.
SALES_EVENTS = """
li AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_shipdate,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS ep, CAST(l_quantity AS INTEGER) AS lq
  FROM lineitem),
lb AS (
  SELECT ok, ln, pk, sk, ep, lq,
         (ok * 31 + ln * 17 + pk * 13 + sk * 7) % 40 AS a,
         pk % 24 AS k,
         1 + lq % 5 AS q0,
         CAST(ep * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS p0,
         CAST(l_shipdate AS TIMESTAMP)
           + to_seconds(CAST((ok * 7919 + ln * 104729 + pk * 31 + sk) % 86400 AS BIGINT)) AS its
  FROM li),
lo AS (
  SELECT *, CASE WHEN a >= 4 THEN (ok * 13 + ln * 29 + pk * 7 + sk * 3) % 64 ELSE 63 END AS b FROM lb),
sales_events AS (
  SELECT
    b = 4 AS broken, b = 1 AS has_channel,
    b <> 4 AND NOT (a = 2 AND pk % 3 = 0) AS has_sale_id,
    b <> 4 AND NOT (a = 2 AND pk % 3 = 1) AS has_user_id,
    b <> 4 AND NOT (a = 2 AND pk % 3 = 2) AS has_product_id,
    b <> 4 AS has_quantity, b NOT IN (4, 10) AS has_unit_price, b NOT IN (4, 11) AS has_total_amount,
    b <> 4 AS has_event_timestamp,
    CASE WHEN has_sale_id AND b NOT IN (12, 16) THEN 'S-' || lpad(CAST(ok AS VARCHAR), 6, '0') || '-' || CAST(ln AS VARCHAR) END AS sale_id,
    CASE WHEN NOT has_user_id THEN NULL WHEN b = 8 THEN 'U-9999'
         ELSE 'U-' || lpad(CAST(ok % 100 + 1 AS VARCHAR), 4, '0') END AS user_id,
    CAST(CASE WHEN NOT has_product_id THEN NULL WHEN b = 9 THEN 999 WHEN k < 6 THEN 101 + k WHEN k < 13 THEN 195 + k
              WHEN k < 18 THEN 288 + k ELSE 383 + k END AS INTEGER) AS product_id,
    CAST(CASE WHEN a = 0 OR b = 16 THEN 0 WHEN b IN (0, 4) THEN NULL WHEN b = 2 THEN q0 + 0.5 WHEN b = 13 THEN -2
              ELSE q0 END AS DOUBLE) AS qty,
    b NOT IN (0, 3, 4) AS qty_number,
    CAST(CASE WHEN qty = floor(qty) THEN qty END AS INTEGER) AS quantity,
    CASE WHEN a = 1 THEN CAST(-5.00 AS DECIMAL(10,2)) WHEN has_unit_price THEN p0 END AS unit_price,
    CASE WHEN b = 15 THEN CAST(12345678901.5 AS DECIMAL(22,2)) WHEN has_total_amount THEN CAST(q0 * p0 AS DECIMAL(22,2)) END AS total_value,
    CASE WHEN b <> 15 AND has_total_amount THEN CAST(q0 * p0 AS DECIMAL(12,2)) END AS total_amount,
    CASE WHEN b = 4 THEN NULL WHEN a = 3 THEN 'corrupted-timestamp'
         WHEN b = 5 THEN strftime(its, '%Y-%m-%dT%H:%M:%S') || '+05:30' WHEN b = 6 THEN strftime(its, '%Y%m%dT%H%M%S')
         WHEN b = 7 THEN strftime(its, '%G-W%V-%u %H:%M:%S') WHEN b = 14 THEN strftime(its, '%d/%m/%Y')
         ELSE strftime(its, '%Y-%m-%d %H:%M:%S') END AS event_timestamp,
    CASE WHEN a <> 3 AND b NOT IN (4, 14) THEN its END AS ets,
    CASE WHEN b = 5 THEN its - INTERVAL 330 MINUTE ELSE its END AS instant,
    CAST('0x' || substr(md5(concat_ws('|', ok, ln, pk, sk, lq, ep, strftime(its, '%Y-%m-%d %H:%M:%S'))), 1, 15) AS BIGINT) AS ingest_key,
    its AS ingest_ts,
    CASE WHEN b = 4 THEN 'not json ' || ok ELSE '{' || concat_ws(',',
      CASE WHEN has_sale_id THEN '"sale_id":' || coalesce('"' || sale_id || '"', 'null') END,
      '"user_id":"' || user_id || '"', '"product_id":' || product_id,
      '"quantity":' || CASE WHEN b = 0 THEN 'null' WHEN b = 2 THEN q0 || '.5' WHEN b = 3 THEN '"' || q0 || '"' ELSE CAST(quantity AS VARCHAR) END,
      '"unit_price":' || unit_price,
      '"total_amount":' || CASE WHEN b = 15 THEN '12345678901.5' ELSE CAST(total_amount AS VARCHAR) END,
      '"event_timestamp":"' || event_timestamp || '"', CASE WHEN has_channel THEN '"channel":"web"' END) || '}' END AS value
  FROM lo)"""

# Python-order classification and enrichment.
TAGGED = """
reasoned AS (
  SELECT *,
    CASE WHEN broken THEN 'malformed'
         WHEN NOT (has_sale_id AND has_user_id AND has_product_id) THEN 'missing_field'
         WHEN has_quantity AND NOT qty_number THEN 'malformed'
         WHEN coalesce(qty, 0) <= 0 THEN 'quantity_zero'
         WHEN coalesce(unit_price, 0) <= 0 THEN 'negative_price'
         WHEN ets IS NULL THEN 'corrupted_timestamp' END AS error_reason,
    CASE WHEN coalesce(total_value, 0) < 50 THEN 'low'
         WHEN coalesce(total_value, 0) < 200 THEN 'medium' ELSE 'high' END AS band
  FROM sales_events),
tagged AS (
  SELECT ingest_key, ingest_ts, broken,
    CASE WHEN error_reason = 'missing_field' AND NOT has_sale_id THEN 'N/A' ELSE sale_id END AS sale_id,
    CASE WHEN error_reason = 'missing_field' AND NOT has_user_id THEN 'N/A' ELSE user_id END AS user_id,
    product_id, quantity, unit_price, total_amount, total_value, event_timestamp, error_reason,
    CASE WHEN error_reason IS NULL THEN ets END AS event_ts,
    CASE WHEN error_reason IS NULL THEN instant END AS event_instant,
    CASE WHEN error_reason IS NULL THEN strftime(ets, '%Y-%m-%d') END AS date_id,
    CASE WHEN error_reason IS NULL THEN band END AS value_band,
    CASE WHEN error_reason IS NULL THEN CAST(hour(ets) AS INTEGER) END AS sale_hour,
    CASE WHEN error_reason IS NULL THEN CAST(minute(ets) AS INTEGER) END AS sale_minute,
    CASE WHEN error_reason IS NULL THEN dayname(ets) END AS day_of_week
  FROM reasoned)"""

# The NOT NULL columns of fact_sales, by their names in fact_input.
FACT_COLUMNS = ["sale_id", "user_id", "product_id", "date_id", "quantity", "unit_price", "total_amount", "value_band",
                "sale_hour", "sale_minute", "day_of_week", "event_timestamp"]

FACTS = f"""
fact_input AS (
  SELECT sale_id, user_id, product_id, CAST(date_id AS DATE) AS date_id, quantity, unit_price,
         total_amount, value_band, sale_hour, sale_minute, day_of_week,
         event_instant AS event_timestamp, ingest_key
  FROM tagged WHERE error_reason IS NULL),
fact_rows AS (SELECT * FROM fact_input WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FACT_COLUMNS)}),
fact_sales AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY ingest_key) AS rn
    FROM fact_rows) WHERE rn = 1)"""

ALERTS = """
anomaly_alerts AS (
  SELECT ingest_key AS id, sale_id, error_reason AS anomaly_type,
    CAST(CASE error_reason WHEN 'missing_field' THEN 1 WHEN 'negative_price' THEN 2
         WHEN 'quantity_zero' THEN 3 WHEN 'corrupted_timestamp' THEN 4 END AS INTEGER) AS anomaly_code,
    event_timestamp, ingest_ts AS detected_at
  FROM tagged
  WHERE error_reason IN ('missing_field', 'negative_price', 'quantity_zero', 'corrupted_timestamp'))"""


def window_cte(time_col: str, name: str = "agg_sales_windowed") -> str:
    """30 s windows sliding by 10 s: each row lands in the 3 windows that
    contain it; bounds as in Spark (multiples of the slide since the epoch).
    The mean is cents rounded half up in integer arithmetic (sums >= 0)."""
    return f"""
{name}_x AS (
  SELECT total_value, unnest([0, 10, 20]) AS o, {time_col} AS t
  FROM tagged WHERE error_reason IS NULL),
{name}_g AS (
  SELECT make_timestamp(CAST((floor(epoch(t) / 10) * 10 - o) * 1000000 AS BIGINT)) AS window_start,
         count(*) AS sale_count,
         sum(coalesce(total_value, 0)) AS rev
  FROM {name}_x GROUP BY 1),
{name} AS (
  SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, sale_count,
         CAST(rev AS DECIMAL(22,2)) AS total_revenue,
         CAST(CAST((2 * CAST(rev * 100 AS BIGINT) + sale_count) // (2 * sale_count) AS DECIMAL(20,0))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(22,2)) AS avg_order_value
  FROM {name}_g)"""


def with_ctes(*parts: str, select: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + select


def tagged_sql(select: str) -> str:
    return with_ctes(SALES_EVENTS, TAGGED, select=select)


def facts_sql(select: str) -> str:
    return with_ctes(SALES_EVENTS, TAGGED, FACTS, select=select)


def alerts_sql(select: str) -> str:
    return with_ctes(SALES_EVENTS, TAGGED, ALERTS, select=select)


def windows_sql(select: str, time_col: str = "event_ts") -> str:
    return with_ctes(SALES_EVENTS, TAGGED, window_cte(time_col), select=select)


# SQL-dialect source: fixed schema, TO_TIMESTAMP with one pattern.
SQL_TYPED = """
sql_src AS (
  SELECT * REPLACE (CASE WHEN qty_number THEN quantity END AS quantity),
         try_strptime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts FROM sales_events)"""

# The predicate and the reason order of the SQL job.
SQL_OK = """(quantity > 0 AND unit_price > 0 AND sale_id IS NOT NULL AND user_id IS NOT NULL
     AND product_id IS NOT NULL AND ts IS NOT NULL)"""
SQL_REASON = """CASE WHEN quantity <= 0 THEN 'quantity_zero' WHEN unit_price <= 0 THEN 'negative_price'
       WHEN sale_id IS NULL OR user_id IS NULL OR product_id IS NULL THEN 'missing_field'
       WHEN ts IS NULL THEN 'corrupted_timestamp' ELSE 'unknown' END"""


def sql_dialect(select: str) -> str:
    return with_ctes(SALES_EVENTS, SQL_TYPED, select=select)
