"""Validation: tag each sale event valid / invalid with a reason.

Event path (primary).  First failing rule wins, in this order:

1. any of sale_id / user_id / product_id *key absent*  -> ``missing_field``
   (the record is rebuilt with exactly the seven fields; absent ids and
   timestamp default to ``'N/A'``, absent numbers to 0)
2. ``quantity`` (absent = 0) <= 0                      -> ``quantity_zero``
3. ``unit_price`` (absent = 0) <= 0                    -> ``negative_price``
4. ``event_timestamp`` not an ISO-8601 string          -> ``corrupted_timestamp``

Everything else is valid and gets enriched.  Events that are not JSON objects,
or whose quantity / price / total is present but not a number (the original
job would raise and stop), are tagged ``malformed`` and routed to the invalid
branch as a dead letter instead of failing the stream.

SQL path (secondary, different rule order): see ``parse_typed`` / ``sql_reason``.

All rules are one ``CASE`` expression evaluated in the JVM; the same functions
run on static frames and on streaming frames.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salespark.functions import json as J
from salespark.functions import money as M
from salespark.functions import time as TS
from salespark.schemas import ENRICH_FIELDS, RAW_EVENT, RAW_FIELDS
from salespark.session import compiled

# Error reasons and alert codes.
MISSING_FIELD = "missing_field"
QUANTITY_ZERO = "quantity_zero"
NEGATIVE_PRICE = "negative_price"
CORRUPTED_TIMESTAMP = "corrupted_timestamp"
MALFORMED = "malformed"
UNKNOWN = "unknown"
ANOMALY_CODES = {
    "missing_field": 1,
    "negative_price": 2,
    "quantity_zero": 3,
    "corrupted_timestamp": 4,
}
NA = "N/A"

V = "_v"  # parsed VARIANT column carried next to the typed columns


def _v() -> Column:
    return F.col(V)


def tag_events(messages: DataFrame, text_col: str = "value") -> DataFrame:
    """Messages (JSON text + arrival metadata) -> tagged events.

    Output: arrival columns, the seven typed fields (NULL where a value does not fit), ``event_ts`` (the clock on the
    text), ``event_instant`` (the same in UTC), ``error_reason`` (NULL = valid), the five enrichment columns (valid rows
    only), ``value`` (the outgoing JSON record) and ``_v`` (the parsed event).
    """
    # a repeated key counts with its last value, whatever session runs this
    messages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    compiled(messages.sparkSession)
    extra = [c for c in messages.columns if c != text_col]
    df = messages.select(*extra, F.col(text_col).alias("_text"),
                         J.parse(F.col(text_col)).alias(V))
    v = _v()
    # The object is walked once into a struct of its fields (absent: NULL; null: a VARIANT null); every later read is
    # a cast of one field.  All of it sits below the metrics node; the projection above it reads plain columns, and
    # ``_v`` is pruned away unless the outgoing record (``value``) or an alert needs it.
    typed_as = {"sale_id": "string", "user_id": "string", "product_id": "int",
                "quantity": "int", "unit_price": "decimal(10,2)",
                "total_amount": "decimal(12,2)", "event_timestamp": "string"}
    numbers = ("product_id", "quantity", "unit_price", "total_amount")
    df = df.select(*extra, "_text", V, J.fields(v, (*RAW_FIELDS, *ENRICH_FIELDS, "error_reason")).alias("_e"))
    # the text of each value is a column of its own: ``J.read`` reads it several times
    df = df.select(*extra, "_text", V, "_e", *[J.text_of(F.col(f"_e.{k}")).alias(f"_j_{k}") for k in RAW_FIELDS])

    def read(k: str, as_type: str) -> Column:
        return J.read(F.col(f"_e.{k}"), F.col(f"_j_{k}"), as_type)

    df = df.select(
        *extra, "_text", V,
        J.is_object(F.col("_text"), v).alias("_is_obj"),
        *[F.col(f"_e.{k}").isNotNull().alias(f"_has_{k}") for k in RAW_FIELDS],
        *[read(k, t).alias(f"_f_{k}") for k, t in typed_as.items() if k != "total_amount"],
        *[read(k, "double").alias(f"_d_{k}") for k in numbers],
        *[J.type_is_number(F.col(f"_e.{k}")).alias(f"_n_{k}") for k in numbers[1:]],
        read("total_amount", "decimal(22,2)").alias("_total_value"),
        F.col("_j_event_timestamp").startswith('"').alias("_s_event_timestamp"),
        F.coalesce(*[F.col(f"_e.{k}") for k in ENRICH_FIELDS]).isNotNull().alias("_has_enrichment"),
        F.col("_e.error_reason").isNotNull().alias("_has_reason"))
    # the timestamp text is a column of its own: ts_iso reads it several times
    df = df.withColumn("_ts_text", F.when(F.col("_s_event_timestamp"), F.col("_f_event_timestamp")))
    df = df.withColumn("_f_total_amount", F.col("_total_value").try_cast(typed_as["total_amount"]))
    df = df.withColumn("event_ts", TS.ts_iso("_ts_text")).withColumn("_json", J.text_of(v))

    def has(k: str) -> Column:
        return F.col(f"_has_{k}")

    reason = (
        F.when(~F.col("_is_obj"), MALFORMED)
        .when(~(has("sale_id") & has("user_id") & has("product_id")), MISSING_FIELD)
        .when(has("quantity") & ~F.col("_n_quantity"), MALFORMED)
        .when(F.coalesce(F.col("_d_quantity"), F.lit(0.0)) <= 0, QUANTITY_ZERO)
        .when(has("unit_price") & ~F.col("_n_unit_price"), MALFORMED)
        .when(F.coalesce(F.col("_d_unit_price"), F.lit(0.0)) <= 0, NEGATIVE_PRICE)
        .when(F.col("event_ts").isNull(), CORRUPTED_TIMESTAMP)
        .when(has("total_amount") & ~F.col("_n_total_amount"), MALFORMED)
    )
    df = _observed(df.withColumn("error_reason", reason))
    missing = F.col("error_reason") == MISSING_FIELD
    valid = F.col("error_reason").isNull()

    def typed(k: str, default) -> Column:
        # missing_field rebuilds the record with .get(k, default)
        t = typed_as[k]
        return F.when(missing & ~has(k), F.lit(default).cast(t)).otherwise(whole(k) if t == "int" else F.col(f"_f_{k}"))

    def whole(k: str) -> Column:
        # a fraction doesn't fit an integer column: NULL, never cut
        return F.when(F.col(f"_f_{k}").cast("double") == F.col(f"_d_{k}"), F.col(f"_f_{k}"))

    ts = F.col("event_ts")
    df = df.select(
        *extra,
        typed("sale_id", NA).alias("sale_id"),
        typed("user_id", NA).alias("user_id"),
        # 'N/A' is not an int: it stays on the wire (value), NULL here
        whole("product_id").alias("product_id"),
        typed("quantity", 0).alias("quantity"),
        typed("unit_price", 0).alias("unit_price"),
        typed("total_amount", 0).alias("total_amount"),
        F.col("_total_value").alias("total_value"),  # also what doesn't fit the fact table's column
        typed("event_timestamp", NA).alias("event_timestamp"),
        F.when(valid, ts).alias("event_ts"),
        F.when(valid, TS.instant(ts, "_ts_text")).alias("event_instant"),
        "error_reason",
        F.when(valid, TS.date_id_text(ts)).alias("date_id"),
        F.when(valid, M.value_band(F.col("_d_total_amount"))).alias("value_band"),
        F.when(valid, F.hour(ts)).alias("sale_hour"),
        F.when(valid, F.minute(ts)).alias("sale_minute"),
        F.when(valid, TS.day_name(ts)).alias("day_of_week"),
        V, "_text", "_json", "_has_enrichment", "_has_reason",
    )
    return df.withColumn("value", _payload()).drop("_text", "_json", "_has_enrichment", "_has_reason")


_OBSERVATIONS = itertools.count()


def _observed(df: DataFrame) -> DataFrame:
    """Attach tagging metrics (events in, invalid events) to the plan.

    Besides reporting counts (query progress of a stream, ``Observation`` of a
    batch), the metrics node keeps the optimizer from pushing later filters on
    ``error_reason`` below it: pushed through, the filter would inline the JSON
    parse and the whole rule CASE once per reference and evaluate them twice
    per row.  Above the node every later column reads the computed values."""
    name = f"tagging_{next(_OBSERVATIONS)}"
    return df.observe(name, F.count(F.lit(1)).alias("events"),
                      F.count("error_reason").alias("invalid_events"))


def _payload() -> Column:
    """The outgoing JSON record of a tagged event."""
    v = _v()
    reason = F.col("error_reason")

    def get_default(k: str, default_json: str) -> Column:
        return F.when(J.has_key(v, k), J.field(v, k)).otherwise(J.variant_lit(default_json))

    rebuilt = F.create_map(
        F.lit("sale_id"), get_default("sale_id", '"N/A"'),
        F.lit("user_id"), get_default("user_id", '"N/A"'),
        F.lit("product_id"), get_default("product_id", '"N/A"'),
        F.lit("quantity"), get_default("quantity", "0"),
        F.lit("unit_price"), get_default("unit_price", "0"),
        F.lit("total_amount"), get_default("total_amount", "0"),
        F.lit("event_timestamp"), get_default("event_timestamp", '"N/A"'),
        F.lit("error_reason"), J.variant_lit('"missing_field"'),
    )
    text = F.col("_json")
    enrich = {c: F.col(c) for c in ENRICH_FIELDS}
    record = (
        F.when(reason.isNull(), J.extend(text, v, enrich, F.col("_has_enrichment")))
         .when(reason == MISSING_FIELD, J.write(rebuilt))
         .otherwise(J.extend(text, v, {"error_reason": reason}, F.col("_has_reason"))))
    # a dead letter keeps the original text untouched
    dead = F.to_json(F.struct(F.col("_text").alias("raw"), reason.alias("error_reason")))
    return F.when(reason == MALFORMED, dead).otherwise(record)


def valid_events(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("error_reason").isNull())


def invalid_events(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("error_reason").isNotNull())


# ---------------------------------------------------------------- alerts

def code_of(reason: Column | str) -> Column:
    """Reason -> anomaly code; NULL for reasons without a code."""
    pairs = []
    for name, code in ANOMALY_CODES.items():
        pairs += [F.lit(name), F.lit(code)]
    r = F.col(reason) if isinstance(reason, str) else reason
    return F.create_map(*pairs)[r]


def coded_alerts(invalid: DataFrame) -> DataFrame:
    """Invalid events -> coded alerts; reasons without a code emit nothing.

    ``sale_id`` / ``event_timestamp`` use ``.get(k, 'N/A')`` on the invalid
    record (a missing-field record already carries the defaults)."""
    v = _v()
    return (invalid
            .withColumn("anomaly_code", code_of("error_reason"))
            .filter(F.col("anomaly_code").isNotNull())
            .select(
                F.col("ingest_key").alias("id"),
                F.when(F.col("error_reason") == MISSING_FIELD, F.col("sale_id"))
                 .otherwise(J.get_default(v, "sale_id", "string", F.lit(NA))).alias("sale_id"),
                F.col("error_reason").alias("anomaly_type"),
                F.col("anomaly_code").cast("int").alias("anomaly_code"),
                F.when(F.col("error_reason") == MISSING_FIELD, F.col("event_timestamp"))
                 .otherwise(J.get_default(v, "event_timestamp", "string", F.lit(NA)))
                 .alias("event_timestamp"),
                F.col("ingest_ts").alias("detected_at")))


def basic_alerts(invalid: DataFrame) -> DataFrame:
    """The ETL job's own alert row: (sale_id, anomaly_type, event_timestamp)
    with ``.get`` defaults N/A / unknown / N/A and no code."""
    v = _v()
    return invalid.select(
        F.col("ingest_key").alias("id"),
        F.when(F.col("error_reason") == MISSING_FIELD, F.col("sale_id"))
         .otherwise(J.get_default(v, "sale_id", "string", F.lit(NA))).alias("sale_id"),
        F.coalesce(F.col("error_reason"), F.lit(UNKNOWN)).alias("anomaly_type"),
        F.when(F.col("error_reason") == MISSING_FIELD, F.col("event_timestamp"))
         .otherwise(J.get_default(v, "event_timestamp", "string", F.lit(NA)))
         .alias("event_timestamp"),
        F.col("ingest_ts").alias("detected_at"))


# ---------------------------------------------------------------- SQL dialect

def parse_typed(messages: DataFrame, text_col: str = "value") -> DataFrame:
    """The SQL job's source table: JSON -> fixed schema (absent and null both
    NULL) plus the computed column ``ts = TO_TIMESTAMP(event_timestamp, ...)``."""
    extra = [c for c in messages.columns if c != text_col]
    typed = (messages
             .select(*extra, F.from_json(F.col(text_col), RAW_EVENT).alias("e"))
             .select(*extra, *[F.col(f"e.{c}").alias(c) for c in RAW_FIELDS])
             .withColumn("ts", TS.ts_pattern("event_timestamp")))
    # metrics node: keeps the WHERE clauses from being pushed below the parse
    # (which would run from_json once per referenced field)
    name = f"sql_source_{next(_OBSERVATIONS)}"
    return typed.observe(name, F.count(F.lit(1)).alias("events"),
                         F.count("ts").alias("parsed_timestamps"))


def sql_ok() -> Column:
    """The SQL job's WHERE clause for facts (three-valued)."""
    return ((F.col("quantity") > 0) & (F.col("unit_price") > 0)
            & F.col("sale_id").isNotNull() & F.col("user_id").isNotNull()
            & F.col("product_id").isNotNull() & F.col("ts").isNotNull())


def sql_reason() -> Column:
    """The SQL job's reason CASE: quantity, price, missing, timestamp, unknown."""
    return (F.when(F.col("quantity") <= 0, QUANTITY_ZERO)
             .when(F.col("unit_price") <= 0, NEGATIVE_PRICE)
             .when(F.col("sale_id").isNull() | F.col("user_id").isNull()
                   | F.col("product_id").isNull(), MISSING_FIELD)
             .when(F.col("ts").isNull(), CORRUPTED_TIMESTAMP)
             .otherwise(UNKNOWN))


def sql_facts(typed: DataFrame) -> DataFrame:
    """``INSERT INTO fact_sale_sink SELECT ... WHERE <ok>`` (12 columns)."""
    ts = F.col("ts")
    return typed.filter(sql_ok()).select(
        "sale_id", "user_id", "product_id",
        ts.cast("date").alias("date_id"),
        "quantity", "unit_price", "total_amount",
        M.value_band_sql("total_amount").alias("value_band"),
        F.hour(ts).cast("int").alias("sale_hour"),
        F.minute(ts).cast("int").alias("sale_minute"),
        TS.day_name(ts).alias("day_of_week"),
        ts.alias("event_timestamp"))


def sql_invalid(typed: DataFrame) -> DataFrame:
    """``... WHERE NOT(<ok>)`` -- a row whose predicate is NULL is in neither
    branch (kept as in the SQL job; see ``sql_dropped``)."""
    return typed.filter(~sql_ok()).select(
        "sale_id", "user_id", "product_id", "quantity", "unit_price",
        "total_amount", "event_timestamp", sql_reason().alias("error_reason"))


def sql_dropped(typed: DataFrame) -> DataFrame:
    """Rows the SQL dialect silently loses (predicate NULL in both branches)."""
    return typed.filter(sql_ok().isNull())


__all__ = ["tag_events", "valid_events", "invalid_events", "coded_alerts",
           "basic_alerts", "parse_typed", "sql_facts", "sql_invalid",
           "sql_dropped", "sql_reason", "code_of", "ANOMALY_CODES"]
