"""The dashboard queries over fact_sales / anomaly_alerts / agg_sales_windowed,
and the panel reducers (sum, max, percent of total, last-not-null, colour
thresholds).

All of them are small group-bys (partial aggregation, one shuffle of at most
#groups x #map-tasks rows) or top-k (``TakeOrderedAndProject``: each task keeps
its k best, the driver merges k x #tasks rows).  Reducers over an aggregated
series run on that series only; the groups are bounded by the key domain
(bands, hours, anomaly types, minutes in the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespark.functions import time as TS
from salespark.schemas import MONEY_SUM

# Colour steps of the latest-window stat panel.
THRESHOLD_YELLOW = 100
THRESHOLD_RED = 500
TOP_PRODUCTS = 10
LATEST_ANOMALIES = 20


def _sum_money(c: str) -> F.Column:
    return F.sum(c).cast(MONEY_SUM)


def revenue_by_band(facts: DataFrame) -> DataFrame:
    """SELECT value_band, SUM(total_amount) revenue, COUNT(*) cnt GROUP BY 1."""
    return (facts.groupBy("value_band")
                 .agg(_sum_money("total_amount").alias("revenue"),
                      F.count(F.lit(1)).alias("cnt"))
                 .orderBy(F.desc("revenue"), "value_band"))


def revenue_by_minute(facts: DataFrame, since=None) -> DataFrame:
    """SELECT date_trunc('minute', event_timestamp) time, SUM(total_amount)."""
    df = facts if since is None else facts.filter(F.col("event_timestamp") >= since)
    return (df.groupBy(TS.minute_bucket("event_timestamp").alias("time"))
              .agg(_sum_money("total_amount").alias("revenue"))
              .orderBy("time"))


def sales_by_hour(facts: DataFrame) -> DataFrame:
    return (facts.groupBy("sale_hour")
                 .agg(F.count(F.lit(1)).alias("cnt"),
                      _sum_money("total_amount").alias("revenue"))
                 .orderBy("sale_hour"))


def product_quantities(facts: DataFrame) -> DataFrame:
    return facts.groupBy("product_id").agg(F.sum("quantity").cast("bigint").alias("qty"))


def top_products(facts: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Top-k products by quantity; ``product_id`` breaks ties."""
    return product_quantities(facts).orderBy(F.desc("qty"), F.asc("product_id")).limit(k)


def anomalies_by_type(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("cnt"))
                  .orderBy(F.desc("cnt"), "anomaly_type"))


def anomalies_by_minute(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy(TS.minute_bucket("detected_at").alias("time"))
                  .agg(F.count(F.lit(1)).alias("anomalies"))
                  .orderBy("time"))


def latest_anomalies(alerts: DataFrame, k: int = LATEST_ANOMALIES) -> DataFrame:
    """The k most recent alerts; the arrival id breaks ties."""
    return (alerts.select("id", "sale_id", "anomaly_type", "anomaly_code", "detected_at")
                  .orderBy(F.desc("detected_at"), F.desc("id")).limit(k))


def latest_window(stats: DataFrame) -> DataFrame:
    """ORDER BY window_end DESC LIMIT 1."""
    return (stats.select("sale_count", "total_revenue", "avg_order_value", "window_end")
                 .orderBy(F.desc("window_end")).limit(1))


def series_sum_max(series: DataFrame, value_col: str) -> DataFrame:
    """Legend reducers of a time-series panel: sum and max of the series."""
    return series.agg(F.sum(value_col).alias(f"{value_col}_sum"),
                      F.max(value_col).alias(f"{value_col}_max"))


def share_of_total(counts: DataFrame, key: str, count_col: str = "cnt") -> DataFrame:
    """Percent of the total per group (pie label), rounded to 2 decimals.

    The total is an aggregate of its own (partial sums per task), read as a scalar subquery; no task sees all groups."""
    total = counts.agg(F.sum(count_col)).scalar()
    pct = F.round(F.col(count_col).cast("decimal(20,0)") * 100 / total, 2).cast("decimal(7,2)")
    return counts.select(key, count_col, pct.alias("pct"))


def colour(value: F.Column) -> F.Column:
    return (F.when(value >= THRESHOLD_RED, "red")
             .when(value >= THRESHOLD_YELLOW, "yellow")
             .otherwise("green"))


def threshold_band(latest: DataFrame) -> DataFrame:
    """Colour of each field of the latest-window stat panel."""
    return latest.select(
        "*",
        colour(F.col("sale_count")).alias("sale_count_colour"),
        colour(F.col("total_revenue")).alias("total_revenue_colour"),
        colour(F.col("avg_order_value")).alias("avg_order_value_colour"))


def last_not_null(stats: DataFrame) -> DataFrame:
    """``lastNotNull`` reducer: per field, the value of the latest window whose
    field is not NULL (a plain aggregate: ``max_by`` over window_end)."""
    out = []
    for c in ("sale_count", "total_revenue", "avg_order_value"):
        out.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("window_end"))).alias(c))
    return stats.agg(*out)
