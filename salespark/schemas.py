"""Record and table schemas (data model of the sales pipeline)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY_UNIT = T.DecimalType(10, 2)     # unit_price
MONEY_TOTAL = T.DecimalType(12, 2)    # total_amount, averages of totals
# Sums of totals keep Spark's natural sum type: a (12,2) column would overflow
# (an ANSI error) once a group holds enough sales.
MONEY_SUM = T.DecimalType(22, 2)

# Raw sale event: seven flat fields, every key may be absent on the wire.
RAW_FIELDS = ("sale_id", "user_id", "product_id", "quantity", "unit_price",
              "total_amount", "event_timestamp")
ID_FIELDS = ("sale_id", "user_id", "product_id")

RAW_EVENT = T.StructType([
    T.StructField("sale_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY_UNIT),
    T.StructField("total_amount", MONEY_TOTAL),
    T.StructField("event_timestamp", T.StringType()),
])

# Columns added to a valid event by enrichment.
ENRICH_FIELDS = ("date_id", "value_band", "sale_hour", "sale_minute", "day_of_week")

# A message on a topic: JSON text plus the transport's arrival metadata
# (Kafka: timestamp, partition, offset).  ``ingest_key`` is the arrival order used
# for first-arrival-wins decisions, unique per message.
TOPIC_MESSAGE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),
    T.StructField("ingest_key", T.LongType()),
])

# Tagged event after classification (error_reason NULL = valid).
TAGGED = T.StructType([
    T.StructField("ingest_key", T.LongType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),
    T.StructField("sale_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY_UNIT),
    T.StructField("total_amount", MONEY_TOTAL),
    T.StructField("total_value", MONEY_SUM),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("event_instant", T.TimestampNTZType()),
    T.StructField("error_reason", T.StringType()),
    T.StructField("date_id", T.StringType()),
    T.StructField("value_band", T.StringType()),
    T.StructField("sale_hour", T.IntegerType()),
    T.StructField("sale_minute", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("value", T.StringType()),
])

# The columns of fact_sales, all NOT NULL.
FACT_COLUMNS = ("sale_id", "user_id", "product_id", "date_id", "quantity",
                "unit_price", "total_amount", "value_band", "sale_hour",
                "sale_minute", "day_of_week", "event_timestamp")

# fact_sales: one row per sale_id (first arrival wins); event_timestamp is the instant, in UTC.
FACT_SALES = T.StructType([
    T.StructField("sale_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("date_id", T.DateType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", MONEY_UNIT, False),
    T.StructField("total_amount", MONEY_TOTAL, False),
    T.StructField("value_band", T.StringType(), False),
    T.StructField("sale_hour", T.IntegerType(), False),
    T.StructField("sale_minute", T.IntegerType(), False),
    T.StructField("day_of_week", T.StringType(), False),
    T.StructField("event_timestamp", T.TimestampNTZType(), False),
    T.StructField("ingest_key", T.LongType()),
])

# The NOT NULL columns of anomaly_alerts.
ALERT_COLUMNS = ("sale_id", "anomaly_type")

# anomaly_alerts: the coded alert; ``id`` is the arrival order (the SERIAL of
# the original table) and ``detected_at`` the arrival clock.
ANOMALY_ALERTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sale_id", T.StringType()),
    T.StructField("anomaly_type", T.StringType(), False),
    T.StructField("anomaly_code", T.IntegerType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("detected_at", T.TimestampNTZType()),
])

# agg_sales_windowed: true window bounds are kept next to the statistics.
AGG_SALES_WINDOWED = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("sale_count", T.LongType()),
    T.StructField("total_revenue", MONEY_SUM),
    T.StructField("avg_order_value", MONEY_SUM),
])

DIM_USER = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("segment", T.StringType(), False),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("brand", T.StringType(), False),
    T.StructField("base_price", MONEY_UNIT, False),
])

# Product catalog file (JSON array): same fields, different order.
CATALOG = T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("base_price", T.DoubleType()),
    T.StructField("brand", T.StringType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.DateType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("day_name", T.StringType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
])
