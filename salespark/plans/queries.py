"""Named batch queries over the supplied tables, each with its SQL oracle.

Every query starts from the whole ``lineitem`` table (through the derived
``sales_events``), so its work grows with the data.  The Spark side goes
through the real event path: rows are serialised to JSON text (as a producer
would), parsed, validated and enriched; the oracle side classifies the typed
rows with plain SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespark.functions import time as TS
from salespark.operators import facts as FA
from salespark.operators import quality as Q
from salespark.operators import reports as R
from salespark.operators import validate as V
from salespark.operators import windows as W
from salespark.functions import json as J
from salespark.functions import money as M
from salespark.plans import oracle as O
from salespark.schemas import ALERT_COLUMNS, FACT_COLUMNS
from salespark.session import work_dir
from salespark.sources import dims as D
from salespark.sources import fixture as FX


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


TAGGED_OUT = ["ingest_key", "sale_id", "user_id", "product_id", "quantity", "unit_price",
              "total_amount", "event_timestamp", "error_reason", "date_id", "value_band",
              "sale_hour", "sale_minute", "day_of_week"]
TAGGED_OUT_SQL = ", ".join(TAGGED_OUT)
FACT_OUT = list(FACT_COLUMNS) + ["ingest_key"]
FACT_OUT_SQL = ", ".join(FACT_OUT)
# FK-test calendar: the fixture's ship dates run 1995..2001.
FK_DATE_START = "1995-01-01"
FK_DATE_END = "2001-12-31"


# ------------------------------------------------------------ shared stages

def tagged(spark: SparkSession, sf: str) -> DataFrame:
    return V.tag_events(FX.raw_messages(spark, sf))


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return V.valid_events(tagged(spark, sf))


def invalid(spark: SparkSession, sf: str) -> DataFrame:
    return V.invalid_events(tagged(spark, sf))


def fact_rows(spark: SparkSession, sf: str) -> DataFrame:
    return FA.by_contract(FA.fact_rows(valid(spark, sf)))[0]


def facts(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """fact_sales; with ``columns`` only those, so that the others don't go through the dedup's shuffle."""
    return FA.fact_sales(valid(spark, sf), columns or None)


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return V.coded_alerts(invalid(spark, sf))


def window_table(spark: SparkSession, sf: str, time_col: str = "event_ts") -> DataFrame:
    return W.window_stats(valid(spark, sf), time_col)


def typed_sql_source(spark: SparkSession, sf: str) -> DataFrame:
    return V.parse_typed(FX.raw_messages(spark, sf))


# ------------------------------------------------------------ registry

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None, doc: str = ""):
    def wrap(fn):
        QUERIES[name] = Query(name, fn, sql, doc)
        return fn
    return wrap


# --- parsing and serialisation ------------------------------------------------

@query("json_typed", O.with_ctes(O.SALES_EVENTS, select="""
SELECT ingest_key, sale_id, user_id, product_id, CASE WHEN qty_number THEN quantity END AS quantity,
  unit_price, total_amount, event_timestamp
FROM sales_events"""), "JSON text -> fixed schema; absent keys come back NULL")
def q_json_typed(spark, sf):
    return typed_sql_source(spark, sf).select(
        "ingest_key", "sale_id", "user_id", "product_id", "quantity", "unit_price",
        "total_amount", "event_timestamp")


@query("json_key_present", O.with_ctes(O.SALES_EVENTS, select="""
SELECT ingest_key, has_sale_id, has_user_id, has_product_id, has_quantity, has_unit_price, has_total_amount,
  has_event_timestamp
FROM sales_events"""), "key-presence test on the parsed event")
def q_json_key_present(spark, sf):
    m = FX.raw_messages(spark, sf).select("ingest_key", J.parse("value").alias("v"))
    return m.select("ingest_key", *[J.has_key("v", k).alias(f"has_{k}")
                                    for k in ("sale_id", "user_id", "product_id", "quantity",
                                              "unit_price", "total_amount", "event_timestamp")])


@query("json_get_default", O.with_ctes(O.SALES_EVENTS, select="""
SELECT ingest_key, CASE WHEN has_sale_id THEN sale_id ELSE 'N/A' END AS sale_id,
  CASE WHEN has_user_id THEN user_id ELSE 'N/A' END AS user_id, CASE WHEN has_quantity THEN qty ELSE 0 END AS quantity,
  CASE WHEN has_event_timestamp THEN event_timestamp ELSE 'N/A' END AS event_timestamp
FROM sales_events"""), "event.get(k, default): default only for absent keys")
def q_json_get_default(spark, sf):
    m = FX.raw_messages(spark, sf).select("ingest_key", J.parse("value").alias("v"))
    return m.select(
        "ingest_key",
        J.get_default("v", "sale_id", "string", F.lit("N/A")).alias("sale_id"),
        J.get_default("v", "user_id", "string", F.lit("N/A")).alias("user_id"),
        J.get_default("v", "quantity", "double", F.lit(0.0)).alias("quantity"),
        J.get_default("v", "event_timestamp", "string", F.lit("N/A")).alias("event_timestamp"))


_ENRICH_KEYS = "['date_id', 'value_band', 'sale_hour', 'sale_minute', 'day_of_week']"


@query("json_merge", O.with_ctes(O.SALES_EVENTS, O.TAGGED, select=f"""
SELECT ingest_key,
  CASE WHEN error_reason = 'malformed' THEN 'error_reason,raw' ELSE array_to_string(list_sort(list_concat(
    CASE WHEN error_reason = 'missing_field'
         THEN ['sale_id', 'user_id', 'product_id', 'quantity', 'unit_price', 'total_amount', 'event_timestamp']
         ELSE list_filter([CASE WHEN has_sale_id THEN 'sale_id' END, CASE WHEN has_user_id THEN 'user_id' END,
                CASE WHEN has_product_id THEN 'product_id' END, CASE WHEN has_quantity THEN 'quantity' END,
                CASE WHEN has_unit_price THEN 'unit_price' END, CASE WHEN has_total_amount THEN 'total_amount' END,
                CASE WHEN has_event_timestamp THEN 'event_timestamp' END, CASE WHEN has_channel THEN 'channel' END],
              lambda k: k IS NOT NULL) END,
    CASE WHEN error_reason IS NULL THEN {_ENRICH_KEYS} ELSE ['error_reason'] END)), ',') END AS keys,
  error_reason,
  CASE WHEN error_reason IS NULL THEN band END AS value_band,
  CASE WHEN error_reason = 'malformed' THEN NULL ELSE product_id END AS product_id
FROM reasoned"""),
       "outgoing JSON: {**event, new} keeps keys; missing_field rebuilds 8 keys")
def q_json_merge(spark, sf):
    record = tagged(spark, sf).select("ingest_key", J.as_map(J.parse("value")).alias("m"))
    return record.select(
        "ingest_key", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"),
        J.as_type(F.col("m")["error_reason"], "string").alias("error_reason"),
        J.as_type(F.col("m")["value_band"], "string").alias("value_band"),
        J.as_type(F.col("m")["product_id"], "int").alias("product_id"))


# --- validation -----------------------------------------------------------------

@query("classify", O.tagged_sql(f"SELECT {TAGGED_OUT_SQL} FROM tagged"),
       "first-failure-wins reason + enrichment, one CASE")
def q_classify(spark, sf):
    return tagged(spark, sf).select(*TAGGED_OUT)


@query("route_valid", O.tagged_sql(f"SELECT {TAGGED_OUT_SQL} FROM tagged WHERE error_reason IS NULL"))
def q_route_valid(spark, sf):
    return valid(spark, sf).select(*TAGGED_OUT)


@query("route_invalid", O.tagged_sql(
    "SELECT ingest_key, sale_id, user_id, product_id, quantity, unit_price, total_amount, "
    "event_timestamp, error_reason FROM tagged WHERE error_reason IS NOT NULL"))
def q_route_invalid(spark, sf):
    return invalid(spark, sf).select(
        "ingest_key", "sale_id", "user_id", "product_id", "quantity", "unit_price",
        "total_amount", "event_timestamp", "error_reason")


def _reason_rows(reason: str):
    def run(spark, sf):
        return (tagged(spark, sf).filter(F.col("error_reason") == reason)
                .select("ingest_key", "sale_id", "quantity", "unit_price", "event_timestamp",
                        "error_reason"))
    sql = O.tagged_sql(
        "SELECT ingest_key, sale_id, quantity, unit_price, event_timestamp, error_reason "
        f"FROM tagged WHERE error_reason = '{reason}'")
    return run, sql


for _id, _reason in (("validate_missing", V.MISSING_FIELD), ("validate_quantity", V.QUANTITY_ZERO),
                     ("validate_price", V.NEGATIVE_PRICE),
                     ("validate_timestamp", V.CORRUPTED_TIMESTAMP)):
    _run, _sql = _reason_rows(_reason)
    QUERIES[_id] = Query(_id, _run, _sql, f"rows tagged {_reason}")


@query("missing_projection", O.tagged_sql("""
SELECT ingest_key, sale_id, user_id, product_id, quantity, unit_price, total_amount,
       event_timestamp, error_reason
FROM tagged WHERE error_reason = 'missing_field'"""), "missing-field rows rebuilt with defaults")
def q_missing_projection(spark, sf):
    return invalid(spark, sf).filter(F.col("error_reason") == V.MISSING_FIELD).select(
        "ingest_key", "sale_id", "user_id", "product_id", "quantity", "unit_price",
        "total_amount", "event_timestamp", "error_reason")


@query("enrichment", O.tagged_sql("""
SELECT ingest_key, date_id, value_band, sale_hour, sale_minute, day_of_week
FROM tagged WHERE error_reason IS NULL"""), "date_id, value_band, hour, minute, weekday")
def q_enrichment(spark, sf):
    return valid(spark, sf).select("ingest_key", "date_id", "value_band", "sale_hour",
                                   "sale_minute", "day_of_week")


def _texts(spark, sf):
    v = J.parse("value")
    return FX.raw_messages(spark, sf).select("ingest_key", J.field(v, "event_timestamp", "string").alias("event_timestamp"))


@query("ts_iso", O.with_ctes(O.SALES_EVENTS, select="""
SELECT ingest_key, event_timestamp, ets AS ts, CASE WHEN ets IS NOT NULL THEN instant END AS instant
FROM sales_events"""), "ISO-8601 parse (offset dropped), NULL when unparsable; the instant in UTC")
def q_ts_iso(spark, sf):
    ts = _texts(spark, sf).withColumn("ts", TS.ts_iso("event_timestamp"))
    return ts.select("*", TS.instant("ts", "event_timestamp").alias("instant"))


@query("value_band", O.tagged_sql("""
SELECT value_band, count(*) AS cnt, CAST(min(total_amount) AS DECIMAL(12,2)) AS min_total,
       CAST(max(total_amount) AS DECIMAL(12,2)) AS max_total
FROM tagged WHERE error_reason IS NULL GROUP BY value_band"""))
def q_value_band(spark, sf):
    return (valid(spark, sf).groupBy("value_band")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.min("total_amount").alias("min_total"),
                 F.max("total_amount").alias("max_total")))


@query("alert_classify", O.alerts_sql(
    "SELECT id, sale_id, anomaly_type, anomaly_code, event_timestamp, detected_at FROM anomaly_alerts"),
    "reason -> code map; reasons without a code emit nothing")
def q_alert_classify(spark, sf):
    return alerts(spark, sf)


@query("sink_anomaly_basic", O.tagged_sql("""
SELECT ingest_key AS id, CASE WHEN broken THEN 'N/A' ELSE sale_id END AS sale_id,
       coalesce(error_reason, 'unknown') AS anomaly_type,
       CASE WHEN broken THEN 'N/A' ELSE event_timestamp END AS event_timestamp, ingest_ts AS detected_at
FROM tagged WHERE error_reason IS NOT NULL"""), "ETL job's own alert rows, defaults N/A/unknown/N/A")
def q_sink_anomaly_basic(spark, sf):
    return V.basic_alerts(invalid(spark, sf))


# --- SQL dialect -------------------------------------------------------------------

@query("sql_valid", O.sql_dialect(f"""
SELECT sale_id, user_id, product_id, CAST(ts AS DATE) AS date_id, quantity, unit_price, total_amount,
  CASE WHEN total_amount < 50 THEN 'low' WHEN total_amount < 200 THEN 'medium' ELSE 'high' END AS value_band,
  CAST(hour(ts) AS INTEGER) AS sale_hour, CAST(minute(ts) AS INTEGER) AS sale_minute,
  dayname(ts) AS day_of_week, ts AS event_timestamp
FROM sql_src WHERE {O.SQL_OK}"""), "SQL job fact branch")
def q_sql_valid(spark, sf):
    return V.sql_facts(typed_sql_source(spark, sf))


@query("sql_invalid", O.sql_dialect(f"""
SELECT sale_id, user_id, product_id, quantity, unit_price, total_amount, event_timestamp,
  {O.SQL_REASON} AS error_reason
FROM sql_src WHERE NOT {O.SQL_OK}"""), "SQL job invalid branch, its own reason order")
def q_sql_invalid(spark, sf):
    return V.sql_invalid(typed_sql_source(spark, sf))


@query("sql_reason", O.sql_dialect(f"""
SELECT {O.SQL_REASON} AS error_reason,
  count(*) AS cnt
FROM sql_src WHERE NOT {O.SQL_OK} GROUP BY 1"""))
def q_sql_reason(spark, sf):
    return (V.sql_invalid(typed_sql_source(spark, sf))
            .groupBy("error_reason").agg(F.count(F.lit(1)).alias("cnt")))


@query("sql_dropped", O.sql_dialect(f"""
SELECT count(*) AS dropped FROM sql_src WHERE ({O.SQL_OK}) IS NULL"""),
       "rows in neither SQL branch (NULL predicate)")
def q_sql_dropped(spark, sf):
    return V.sql_dropped(typed_sql_source(spark, sf)).agg(F.count(F.lit(1)).alias("dropped"))


# --- constraints, dedup, FK ----------------------------------------------------------

@query("pk_first_wins", O.facts_sql(f"SELECT {FACT_OUT_SQL} FROM fact_sales"),
       "fact_sales: one row per sale_id, first arrival wins")
def q_pk_first_wins(spark, sf):
    return facts(spark, sf).select(*FACT_OUT)


@query("conflict_anti", O.facts_sql("""
SELECT r.sale_id, r.ingest_key FROM fact_rows r
WHERE NOT EXISTS (SELECT 1 FROM fact_sales f WHERE f.sale_id = r.sale_id AND f.ingest_key = r.ingest_key)"""),
       "rows an ON CONFLICT DO NOTHING insert skips (later arrivals of a sale id)")
def q_conflict_anti(spark, sf):
    # the events are read, parsed and tagged once: the two narrow columns are stored, then compared
    path = work_dir(spark, "conflict")
    fact_rows(spark, sf).select("sale_id", "ingest_key").write.parquet(path)
    rows = spark.read.parquet(path)
    kept = rows.groupBy("sale_id").agg(F.min("ingest_key").alias("ingest_key"))
    return rows.join(kept, ["sale_id", "ingest_key"], "left_anti")


@query("fact_rejects", O.facts_sql(f"""
SELECT ingest_key, sale_id, array_to_string(list_filter([{', '.join(f"CASE WHEN {c} IS NULL THEN '{c}_not_null' END" for c in O.FACT_COLUMNS)}],
       lambda x: x IS NOT NULL), ',') AS violations
FROM fact_input EXCEPT ALL SELECT ingest_key, sale_id, '' FROM fact_rows"""),
       "valid events that break the fact table's contract, with the rules they break")
def q_fact_rejects(spark, sf):
    _, bad = FA.by_contract(FA.fact_rows(valid(spark, sf)))
    return bad.select("ingest_key", "sale_id", F.array_join("violations", ",").alias("violations"))


_FACT_RULES_SQL = """
SELECT 'quantity_positive' AS rule, count(*) FILTER (WHERE NOT (quantity > 0)) AS failures FROM fact_rows
UNION ALL SELECT 'unit_price_positive', count(*) FILTER (WHERE NOT (unit_price > 0)) FROM fact_rows
UNION ALL SELECT 'total_amount_positive', count(*) FILTER (WHERE NOT (total_amount > 0)) FROM fact_rows
UNION ALL SELECT 'value_band_known', count(*) FILTER (WHERE NOT (value_band IN ('low', 'medium', 'high'))) FROM fact_rows
UNION ALL SELECT 'value_band_in_schema', count(*) FILTER (WHERE NOT (value_band IN ('low', 'mid', 'high'))) FROM fact_rows
UNION ALL SELECT 'sale_hour_range', count(*) FILTER (WHERE NOT (sale_hour BETWEEN 0 AND 23)) FROM fact_rows
UNION ALL SELECT 'sale_minute_range', count(*) FILTER (WHERE NOT (sale_minute BETWEEN 0 AND 59)) FROM fact_rows"""


@query("check_fact", O.facts_sql(_FACT_RULES_SQL),
       "CHECK constraints of fact_sales as rule failure counts (the emitted band set, and the DDL's under its own name)")
def q_check_fact(spark, sf):
    return Q.rule_counts(fact_rows(spark, sf), Q.fact_rules())


_NOT_NULL_SQL = " UNION ALL ".join(
    [f"SELECT 'fact_sales.{c}' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM fact_input" for c in O.FACT_COLUMNS]
    + [f"SELECT 'anomaly_alerts.{c}' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM anomaly_alerts"
       for c in ALERT_COLUMNS])


@query("check_not_null", O.with_ctes(O.SALES_EVENTS, O.TAGGED, O.FACTS, O.ALERTS, select=_NOT_NULL_SQL),
       "NOT NULL constraints of the fact table over valid events, of the alerts over coded alerts")
def q_check_not_null(spark, sf):
    def counts(df, table, columns):
        return Q.rule_counts(df, {f"{table}.{c}": F.col(c).isNotNull() for c in columns})
    return counts(FA.fact_rows(valid(spark, sf)), "fact_sales", FACT_COLUMNS).union(
        counts(alerts(spark, sf), "anomaly_alerts", ALERT_COLUMNS))


def _fk(spark, sf):
    return Q.fk_split(fact_rows(spark, sf), D.dim_user(spark), D.dim_product(spark),
                      D.dim_date(spark, FK_DATE_START, FK_DATE_END))


_FK_SQL = O.facts_sql(f"""
SELECT r.sale_id, r.ingest_key, r.user_id, r.product_id, r.date_id FROM fact_rows r
WHERE {{neg}}(r.user_id IN (SELECT 'U-' || lpad(CAST(i AS VARCHAR), 4, '0') FROM range(1, 101) t(i))
  AND r.product_id IN (101, 102, 103, 104, 105, 106, 201, 202, 203, 204, 205, 206, 207,
                       301, 302, 303, 304, 305, 401, 402, 403, 404, 405, 406)
  AND r.date_id BETWEEN DATE '{FK_DATE_START}' AND DATE '{FK_DATE_END}')""")


@query("fk_semi", _FK_SQL.replace("{neg}", ""), "fact rows whose user, product and date exist")
def q_fk_semi(spark, sf):
    ok, _ = _fk(spark, sf)
    return ok.select("sale_id", "ingest_key", "user_id", "product_id", "date_id")


@query("fk_anti", _FK_SQL.replace("{neg}", "NOT "), "orphan fact rows")
def q_fk_anti(spark, sf):
    _, bad = _fk(spark, sf)
    return bad.select("sale_id", "ingest_key", "user_id", "product_id", "date_id")


@query("dim_date_build", O.facts_sql("""
SELECT CAST(d AS DATE) AS date_id, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  rpad(monthname(d), 9, ' ') AS month_name, CAST(day(d) AS INTEGER) AS day,
  CAST(dayofweek(d) AS INTEGER) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
  dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(CAST(min(date_id) AS TIMESTAMP), CAST(max(date_id) AS TIMESTAMP),
                                    INTERVAL 1 DAY)) AS d FROM fact_sales)"""),
       "calendar dimension over the facts' date range")
def q_dim_date_build(spark, sf):
    return D.dim_date_covering(facts(spark, sf, "date_id"), "date_id")


# The oracle's dimension rows come from the same plain lists of fixed values as the dimensions.
_USERS_SQL = "(VALUES " + ", ".join(f"('{u}', '{g}')" for u, g in D.user_rows()) + ") u(user_id, segment)"
_PRODUCTS_SQL = "(VALUES " + ", ".join(
    f"({i}, '{c}', CAST({p} AS DECIMAL(10,2)))" for i, _, c, _, p in D.product_rows()) + ") p(product_id, category, base_price)"


def _check_sql(table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT ({r})) AS failures FROM {table}" for n, r in rules.items())


@query("check_dims", O.facts_sql(" UNION ALL ".join([
    _check_sql(_USERS_SQL, {"segment_known": "segment IN ('new', 'regular', 'vip')"}),
    _check_sql(_PRODUCTS_SQL, {"category_known": "category IN (" + ", ".join(f"'{c}'" for c in D.CATEGORIES) + ")",
                               "base_price_positive": "base_price > 0"}),
    _check_sql("(SELECT unnest(generate_series(CAST(min(date_id) AS TIMESTAMP), CAST(max(date_id) AS TIMESTAMP), "
               "INTERVAL 1 DAY)) AS d FROM fact_sales)",
               {"year_range": "year(d) BETWEEN 2000 AND 2100", "quarter_range": "quarter(d) BETWEEN 1 AND 4",
                "month_range": "month(d) BETWEEN 1 AND 12", "day_range": "day(d) BETWEEN 1 AND 31",
                "day_of_week_range": "dayofweek(d) BETWEEN 0 AND 6"})])),
       "the CHECKs of the three dimensions (calendar: the data's range)")
def q_check_dims(spark, sf):
    frames = {"dim_user": D.dim_user(spark), "dim_product": D.dim_product(spark),
              "dim_date": D.dim_date_covering(facts(spark, sf, "date_id"), "date_id")}
    counts = [Q.rule_counts(frames[t], rules) for t, rules in Q.dim_rules().items()]
    return counts[0].union(counts[1]).union(counts[2])


@query("fact_enriched", O.facts_sql(f"""
SELECT p.category, u.segment, count(*) AS sales, CAST(sum(f.total_amount) AS DECIMAL(22,2)) AS revenue
FROM fact_sales f JOIN {_USERS_SQL} USING (user_id) JOIN {_PRODUCTS_SQL} USING (product_id)
GROUP BY 1, 2"""), "star join: facts x user and product dimensions")
def q_fact_enriched(spark, sf):
    f = facts(spark, sf, "user_id", "product_id", "total_amount")
    return (f.join(D.dim_user(spark), "user_id").join(D.dim_product(spark), "product_id")
             .groupBy("category", "segment")
             .agg(F.count(F.lit(1)).alias("sales"),
                  F.sum("total_amount").cast("decimal(22,2)").alias("revenue")))


# --- windows ---------------------------------------------------------------------

_WIN_OUT = "window_start, window_end, sale_count, total_revenue, avg_order_value"


@query("agg_window_stats", O.windows_sql(f"SELECT {_WIN_OUT} FROM agg_sales_windowed"),
       "30 s / 10 s sliding windows on event time: count, revenue, mean")
def q_agg_window_stats(spark, sf):
    return window_table(spark, sf, "event_ts")


@query("processing_time", O.windows_sql(f"SELECT {_WIN_OUT} FROM agg_sales_windowed", "ingest_ts"),
       "the same windows on the arrival clock")
def q_processing_time(spark, sf):
    return window_table(spark, sf, "ingest_ts")


@query("agg_empty_guard", O.tagged_sql("""
SELECT count(*) AS sale_count, CAST(coalesce(sum(coalesce(total_value, 0)), 0) AS DECIMAL(22,2)) AS total_revenue,
  CAST(CASE WHEN count(*) = 0 THEN 0 ELSE
    CAST((2 * CAST(coalesce(sum(coalesce(total_value, 0)), 0) * 100 AS BIGINT) + count(*)) // (2 * count(*))
         AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) END AS DECIMAL(22,2)) AS avg_order_value
FROM tagged WHERE error_reason IS NULL"""), "whole-stream statistics, zeros when empty")
def q_agg_empty_guard(spark, sf):
    return W.empty_guarded(valid(spark, sf))


# --- dashboard reports -------------------------------------------------------------

@query("agg_by_band", O.facts_sql("""
SELECT value_band, CAST(sum(total_amount) AS DECIMAL(22,2)) AS revenue, count(*) AS cnt
FROM fact_sales GROUP BY value_band ORDER BY revenue DESC"""))
def q_agg_by_band(spark, sf):
    return R.revenue_by_band(facts(spark, sf, "value_band", "total_amount"))


@query("agg_revenue_minute", O.facts_sql("""
SELECT date_trunc('minute', event_timestamp) AS time, CAST(sum(total_amount) AS DECIMAL(22,2)) AS revenue
FROM fact_sales GROUP BY 1 ORDER BY 1"""))
def q_agg_revenue_minute(spark, sf):
    return R.revenue_by_minute(facts(spark, sf, "event_timestamp", "total_amount"))


@query("agg_anomaly_type", O.alerts_sql("""
SELECT anomaly_type, count(*) AS cnt FROM anomaly_alerts GROUP BY anomaly_type ORDER BY cnt DESC"""))
def q_agg_anomaly_type(spark, sf):
    return R.anomalies_by_type(alerts(spark, sf))


@query("agg_anomaly_minute", O.alerts_sql("""
SELECT date_trunc('minute', detected_at) AS time, count(*) AS anomalies FROM anomaly_alerts GROUP BY 1 ORDER BY 1"""))
def q_agg_anomaly_minute(spark, sf):
    return R.anomalies_by_minute(alerts(spark, sf))


@query("agg_by_hour", O.facts_sql("""
SELECT sale_hour, count(*) AS cnt, CAST(sum(total_amount) AS DECIMAL(22,2)) AS revenue
FROM fact_sales GROUP BY sale_hour ORDER BY sale_hour"""))
def q_agg_by_hour(spark, sf):
    return R.sales_by_hour(facts(spark, sf, "sale_hour", "total_amount"))


@query("agg_product_qty", O.facts_sql("""
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS qty FROM fact_sales GROUP BY product_id"""))
def q_agg_product_qty(spark, sf):
    return R.product_quantities(facts(spark, sf, "product_id", "quantity"))


@query("topk_products", O.facts_sql("""
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS qty FROM fact_sales GROUP BY product_id
ORDER BY qty DESC, product_id LIMIT 10"""), "top 10 products by quantity")
def q_topk_products(spark, sf):
    return R.top_products(facts(spark, sf, "product_id", "quantity"))


@query("latest_anomalies", O.alerts_sql("""
SELECT id, sale_id, anomaly_type, anomaly_code, detected_at FROM anomaly_alerts
ORDER BY detected_at DESC, id DESC LIMIT 20"""), "20 most recent alerts")
def q_latest_anomalies(spark, sf):
    return R.latest_anomalies(alerts(spark, sf))


@query("latest_window", O.windows_sql("""
SELECT sale_count, total_revenue, avg_order_value, window_end FROM agg_sales_windowed
ORDER BY window_end DESC LIMIT 1"""))
def q_latest_window(spark, sf):
    return R.latest_window(window_table(spark, sf))


@query("threshold_band", O.windows_sql("""
SELECT sale_count, total_revenue, avg_order_value, window_end,
  CASE WHEN sale_count >= 500 THEN 'red' WHEN sale_count >= 100 THEN 'yellow' ELSE 'green' END AS sale_count_colour,
  CASE WHEN total_revenue >= 500 THEN 'red' WHEN total_revenue >= 100 THEN 'yellow' ELSE 'green' END AS total_revenue_colour,
  CASE WHEN avg_order_value >= 500 THEN 'red' WHEN avg_order_value >= 100 THEN 'yellow' ELSE 'green' END AS avg_order_value_colour
FROM (SELECT * FROM agg_sales_windowed ORDER BY window_end DESC LIMIT 1)"""),
       "colour steps of the latest-window panel")
def q_threshold_band(spark, sf):
    return R.threshold_band(R.latest_window(window_table(spark, sf)))


@query("last_not_null", O.windows_sql("""
SELECT arg_max(sale_count, window_end) AS sale_count, arg_max(total_revenue, window_end) AS total_revenue,
       arg_max(avg_order_value, window_end) AS avg_order_value FROM agg_sales_windowed"""))
def q_last_not_null(spark, sf):
    return R.last_not_null(window_table(spark, sf))


@query("series_sum_max", O.facts_sql("""
SELECT CAST(sum(revenue) AS DECIMAL(22,2)) AS revenue_sum, CAST(max(revenue) AS DECIMAL(22,2)) AS revenue_max
FROM (SELECT date_trunc('minute', event_timestamp) AS time, sum(total_amount) AS revenue
      FROM fact_sales GROUP BY 1)"""), "legend reducers sum/max over the revenue-per-minute series")
def q_series_sum_max(spark, sf):
    s = R.series_sum_max(R.revenue_by_minute(facts(spark, sf, "event_timestamp", "total_amount")), "revenue")
    return s.select(F.col("revenue_sum").cast("decimal(22,2)").alias("revenue_sum"),
                    F.col("revenue_max").cast("decimal(22,2)").alias("revenue_max"))


@query("share_of_total", O.alerts_sql("""
SELECT anomaly_type, cnt,
  CAST(CAST((20000 * cnt + sum(cnt) OVER ()) // (2 * sum(cnt) OVER ()) AS DECIMAL(20,0))
       * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(7,2)) AS pct
FROM (SELECT anomaly_type, count(*) AS cnt FROM anomaly_alerts GROUP BY 1)"""),
       "percent of all alerts per type")
def q_share_of_total(spark, sf):
    return R.share_of_total(R.anomalies_by_type(alerts(spark, sf)), "anomaly_type")


# --- stream data-quality checks ------------------------------------------------------

@query("dq_event_quality", O.with_ctes(O.SALES_EVENTS, select="""
SELECT count(*) AS events, count(*) FILTER (WHERE has_channel) AS unknown_key_events,
  count(*) FILTER (WHERE event_timestamp <> 'corrupted-timestamp'
                   AND NOT regexp_matches(event_timestamp, '^\\d{4}-\\d{2}-\\d{2}[T ]\\d{2}:\\d{2}:\\d{2}')) AS bad_ts_events,
  count(*) FILTER (WHERE qty < 0) AS negative_qty_events,
  count(*) FILTER (WHERE NOT broken AND (qty = 0 OR unit_price < 0 OR NOT has_sale_id
                   OR event_timestamp = 'corrupted-timestamp')) AS anomaly_events
FROM sales_events"""), "schema, timestamp shape, quantity sign, anomalies present")
def q_dq_event_quality(spark, sf):
    return Q.event_quality(FX.raw_messages(spark, sf)).select(
        "events", "unknown_key_events", "bad_ts_events", "negative_qty_events", "anomaly_events")


def oracle_map() -> dict[str, str]:
    return {k: q.sql for k, q in QUERIES.items() if q.sql is not None}


def query_map() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in QUERIES.items()}


# --- late additions: SQL-job timestamp parse, payload size --------------------

@query("ts_pattern", O.with_ctes(O.SALES_EVENTS, select="""
SELECT ingest_key, try_strptime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts FROM sales_events"""),
       "TO_TIMESTAMP(s, 'yyyy-MM-dd HH:mm:ss'), NULL when unparsable")
def q_ts_pattern(spark, sf):
    return _texts(spark, sf).select("ingest_key", TS.ts_pattern("event_timestamp").alias("ts"))


@query("dq_payload_size", O.with_ctes(O.SALES_EVENTS, select="""
SELECT count(*) AS events, CAST(sum(strlen(value)) AS BIGINT) AS total_bytes,
       CAST(min(strlen(value)) AS INTEGER) AS min_bytes, CAST(max(strlen(value)) AS INTEGER) AS max_bytes,
       CAST(CAST((200 * CAST(sum(strlen(value)) AS BIGINT) + count(*)) // (2 * count(*)) AS DECIMAL(20,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS avg_bytes
FROM sales_events"""),
       "serialised event size: count, total, min, max and average bytes")
def q_dq_payload_size(spark, sf):
    n = F.octet_length("value")
    total = FX.raw_messages(spark, sf).agg(
        F.count(F.lit(1)).alias("events"), F.sum(n).cast("bigint").alias("total_bytes"),
        F.min(n).alias("min_bytes"), F.max(n).alias("max_bytes"))
    mean = F.round(F.col("total_bytes").cast("decimal(20,0)") / F.col("events"), 2).cast("decimal(12,2)")
    return total.withColumn("avg_bytes", mean)


@query("series_sum_max_anomalies", O.alerts_sql("""
SELECT CAST(sum(anomalies) AS BIGINT) AS anomalies_sum, CAST(max(anomalies) AS BIGINT) AS anomalies_max
FROM (SELECT date_trunc('minute', detected_at) AS time, count(*) AS anomalies FROM anomaly_alerts GROUP BY 1)"""),
       "legend reducers sum/max over the anomalies-per-minute series")
def q_series_sum_max_anomalies(spark, sf):
    s = R.series_sum_max(R.anomalies_by_minute(alerts(spark, sf)), "anomalies")
    return s.select(F.col("anomalies_sum").cast("bigint").alias("anomalies_sum"),
                    F.col("anomalies_max").cast("bigint").alias("anomalies_max"))
