"""``sales_events``: sale events derived from the ``lineitem`` table.

No supplied table holds sale events, so they are derived row by row from
``lineitem`` (a pure projection: no shuffle, scales with the table).  The rules
are fixed so that an independent SQL engine can derive the same rows (see
``salespark.plans.oracle.SALES_EVENTS``).

Every field is derived as its JSON text, NULL where the key is absent, so events can hold what only JSON can:
explicit nulls, strings where numbers belong, fractions, unknown keys and texts that are not JSON at all.

Extra arrival metadata stands in for what a message bus attaches:

* ``ingest_key`` -- arrival order (a Kafka offset stand-in), used by the
  first-arrival-wins rules: 60 bits of a hash of the row, unique and unlike the order of event times;
* ``ingest_ts``  -- arrival clock (a Kafka record timestamp stand-in), used for
  processing-time windows and alert ``detected_at``; it is the event time
  before any corruption of the event text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespark.schemas import RAW_FIELDS
from salespark.session import compiled
from salespark.sources.tables import read_table, spread

# Derivation rules of the fixture (FIXTURES.md section 2).  ``a`` picks the five ordinary anomalies,
# ``b`` the odd cases among the other events.
FIXTURE_JSON = {
    "sale_id": "CASE WHEN a = 2 AND pk % 3 = 0 THEN NULL WHEN b IN (12, 16) THEN 'null' "
               "ELSE concat('\"S-', lpad(CAST(ok AS STRING), 6, '0'), '-', CAST(ln AS STRING), '\"') END",
    "user_id": "CASE WHEN a = 2 AND pk % 3 = 1 THEN NULL WHEN b = 8 THEN '\"U-9999\"' "
               "ELSE concat('\"U-', lpad(CAST(ok % 100 + 1 AS STRING), 4, '0'), '\"') END",
    "product_id": "CAST(CASE WHEN a = 2 AND pk % 3 = 2 THEN NULL WHEN b = 9 THEN 999 WHEN k < 6 THEN 101 + k "
                  "WHEN k < 13 THEN 195 + k WHEN k < 18 THEN 288 + k ELSE 383 + k END AS STRING)",
    "quantity": "CASE WHEN a = 0 OR b = 16 THEN '0' WHEN b = 0 THEN 'null' WHEN b = 2 THEN concat(q0, '.5') "
                "WHEN b = 3 THEN concat('\"', q0, '\"') WHEN b = 13 THEN '-2' ELSE CAST(q0 AS STRING) END",
    "unit_price": "CASE WHEN a = 1 THEN '-5.00' WHEN b = 10 THEN NULL ELSE CAST(p0 AS STRING) END",
    "total_amount": "CASE WHEN b = 11 THEN NULL WHEN b = 15 THEN '12345678901.5' "
                    "ELSE CAST(CAST(q0 * p0 AS DECIMAL(12,2)) AS STRING) END",
    # NTZ, whole seconds: zone-free text
    "event_timestamp": "concat('\"', CASE WHEN a = 3 THEN 'corrupted-timestamp' "
                       "WHEN b = 5 THEN concat(replace(its_text, ' ', 'T'), '+05:30') "
                       "WHEN b = 6 THEN translate(replace(its_text, ' ', 'T'), '-:', '') "
                       "WHEN b = 7 THEN concat(extract(YEAROFWEEK FROM its), '-W', lpad(weekofyear(its), 2, '0'), '-', "
                       "weekday(its) + 1, substr(its_text, 11)) "
                       "WHEN b = 14 THEN concat(substr(its_text, 9, 2), '/', substr(its_text, 6, 2), '/', substr(its_text, 1, 4)) "
                       "ELSE its_text END, '\"')",
    "channel": "CASE WHEN b = 1 THEN '\"web\"' END",  # a key that no one knows
}
INGEST_KEY = ("CAST(conv(substr(md5(concat_ws('|', ok, ln, pk, sk, lq, ep, CAST(its AS STRING))), 1, 15), 16, 10) "
              "AS BIGINT) AS ingest_key")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as messages on the raw topic: JSON text + arrival metadata."""
    compiled(spark)
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
        F.col("l_shipdate"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("ep"),
        F.col("l_quantity").cast("int").alias("lq"))
    base = spread(li).selectExpr(
        "*",
        "(ok * 31 + ln * 17 + pk * 13 + sk * 7) % 40 AS a",
        "pk % 24 AS k",
        "1 + lq % 5 AS q0",
        "CAST(ep * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS p0",
        "CAST(timestampadd(SECOND, CAST((ok * 7919 + ln * 104729 + pk * 31 + sk) % 86400 AS INT), "
        "l_shipdate) AS TIMESTAMP_NTZ) AS its")
    odd = base.selectExpr("*", "CASE WHEN a >= 4 THEN (ok * 13 + ln * 29 + pk * 7 + sk * 3) % 64 ELSE 63 END AS b",
                          "CAST(its AS STRING) AS its_text")
    json = odd.selectExpr(INGEST_KEY, "its AS ingest_ts", "b", "ok", *[f"{e} AS {k}" for k, e in FIXTURE_JSON.items()])
    pairs = [F.concat(F.lit(f'"{k}":'), F.col(k)) for k in FIXTURE_JSON]  # NULL where the key is absent
    text = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    broken = F.concat(F.lit("not json "), F.col("ok").cast("string"))
    return json.select(F.when(F.col("b") == 4, broken).otherwise(text).alias("value"), "ingest_ts", "ingest_key")


__all__ = ["raw_messages", "RAW_FIELDS"]
