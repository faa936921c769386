"""Table constraints as data-quality operators, FK checks and stream checks.

Constraints of the star schema become boolean rule columns: a row passes when
every rule holds; a violating row carries the list of failed rule names.
FK checks are joins against the dimensions' key sets; adaptive execution broadcasts a dimension whose measured
size is small and shuffles a large one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salespark.functions import money as M
from salespark.schemas import FACT_COLUMNS
from salespark.sources import dims as D


def fact_rules(band_values=M.BANDS) -> dict[str, Column]:
    """CHECK constraints of fact_sales.  The star schema's DDL lists bands
    low/mid/high while the pipeline emits medium: ``value_band_known`` checks the emitted set
    (or ``band_values``), ``value_band_in_schema`` the one of the DDL."""
    c = F.col
    return {
        "quantity_positive": c("quantity") > 0,
        "unit_price_positive": c("unit_price") > 0,
        "total_amount_positive": c("total_amount") > 0,
        "value_band_known": c("value_band").isin(*band_values),
        "value_band_in_schema": c("value_band").isin(*M.SCHEMA_BANDS),
        "sale_hour_range": c("sale_hour").between(0, 23),
        "sale_minute_range": c("sale_minute").between(0, 59),
    }


def not_null_rules(columns) -> dict[str, Column]:
    return {f"{col}_not_null": F.col(col).isNotNull() for col in columns}


def dim_rules() -> dict[str, dict[str, Column]]:
    c = F.col
    return {
        "dim_user": {"segment_known": c("segment").isin(*D.SEGMENTS)},
        "dim_product": {"category_known": c("category").isin(*D.CATEGORIES),
                        "base_price_positive": c("base_price") > 0},
        "dim_date": {"year_range": c("year").between(2000, 2100),
                     "quarter_range": c("quarter").isin(1, 2, 3, 4),
                     "month_range": c("month").between(1, 12),
                     "day_range": c("day").between(1, 31),
                     "day_of_week_range": c("day_of_week").between(0, 6)},
    }


def with_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``violations``: names of the rules that are false.  As with SQL
    CHECK constraints a rule that evaluates to NULL passes; NULLs are caught
    by the explicit NOT NULL rules."""
    failed = [F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("violations", F.filter(F.array(*failed), lambda x: x.isNotNull()))


def split_by_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(passing rows, violating rows with their ``violations``)."""
    tagged = with_violations(df, rules)
    ok = tagged.filter(F.size("violations") == 0).drop("violations")
    bad = tagged.filter(F.size("violations") > 0)
    return ok, bad


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: how many rows fail it (one pass, one global agg;
    NULL passes, as in ``with_violations``)."""
    aggs = [F.sum(F.when(~F.coalesce(r, F.lit(True)), 1).otherwise(0)).cast("bigint").alias(n)
            for n, r in rules.items()]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    return wide.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, failures)")


def fk_join(facts: DataFrame, dim: DataFrame, key: str, how: str, fact_key: str | None = None) -> DataFrame:
    """``left_semi`` (rows whose key exists) or ``left_anti`` (orphans)."""
    d = dim.select(F.col(key).alias("_dk")).distinct()
    return facts.join(d, F.col(fact_key or key) == F.col("_dk"), how)


def fk_split(facts: DataFrame, users: DataFrame, products: DataFrame,
             dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose three foreign keys all exist, orphan rows with the missing ones)."""
    u = users.select(F.col("user_id").alias("_u")).distinct()
    p = products.select(F.col("product_id").alias("_p")).distinct()
    d = dates.select(F.col("date_id").alias("_d")).distinct()
    marked = (facts
              .join(u, F.col("user_id") == F.col("_u"), "left")
              .join(p, F.col("product_id") == F.col("_p"), "left")
              .join(d, F.col("date_id") == F.col("_d"), "left"))
    missing = F.filter(F.array(
        F.when(F.col("_u").isNull(), F.lit("user_id")),
        F.when(F.col("_p").isNull(), F.lit("product_id")),
        F.when(F.col("_d").isNull(), F.lit("date_id"))), lambda x: x.isNotNull())
    marked = marked.withColumn("missing_keys", missing).drop("_u", "_p", "_d")
    ok = marked.filter(F.size("missing_keys") == 0).drop("missing_keys")
    orphans = marked.filter(F.size("missing_keys") > 0)
    return ok, orphans


#: The foreign keys of fact_sales: column (of the same name in the dimension) and dimension.
FOREIGN_KEYS = {"user_id": "dim_user", "product_id": "dim_product", "date_id": "dim_date"}


def with_foreign_keys(facts: DataFrame, dims: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, Column]]:
    """(``facts`` with a mark for each foreign key, the rules over the marks).  A null key passes, as in SQL.

    ``facts`` may be a stream and ``dims`` static: each join is a stream-static left join."""
    rules = {}
    for key, table in FOREIGN_KEYS.items():
        mark = f"_has_{key}"
        known = dims[table].select(F.col(key).alias(f"_dim_{key}")).distinct().withColumn(mark, F.lit(True))
        facts = facts.join(known, F.col(key) == F.col(f"_dim_{key}"), "left").drop(f"_dim_{key}")
        rules[f"{key}_in_{table}"] = F.col(key).isNull() | F.col(mark).isNotNull()
    return facts, rules


# ------------------------------------------------------------- stream checks

KNOWN_FIELDS = ("sale_id", "user_id", "product_id", "quantity", "unit_price",
                "total_amount", "event_timestamp")
# Timestamp shape of generated events (start of text only).
TS_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}"


def event_quality(messages: DataFrame, text_col: str = "value") -> DataFrame:
    """One-row report over raw event JSON:

    * ``unknown_key_events`` events with a key outside the seven known fields
    * ``bad_ts_events``      timestamps not shaped ``yyyy-mm-dd[T ]hh:mm:ss``
                             (absent, empty and ``corrupted-timestamp`` excused)
    * ``negative_qty_events`` quantity < 0
    * ``anomaly_events``     quantity 0, price < 0, no sale_id or corrupted ts
    * payload bytes: avg / min / max of the JSON text.
    """
    t = F.col(text_col)
    keys = F.json_object_keys(t)
    ts = F.get_json_object(t, "$.event_timestamp")
    qty = F.get_json_object(t, "$.quantity").try_cast("double")
    price = F.get_json_object(t, "$.unit_price").try_cast("double")
    has_sale = F.array_contains(keys, "sale_id")
    unknown = F.size(F.array_except(keys, F.array(*[F.lit(k) for k in KNOWN_FIELDS]))) > 0
    bad_ts = (ts.isNotNull() & (ts != "") & (ts != "corrupted-timestamp") & ~ts.rlike(TS_SHAPE))
    anomaly = ((qty == 0) | (price < 0) | ~has_sale | (ts == "corrupted-timestamp"))
    n = F.octet_length(t)

    def count_if(c: Column) -> Column:
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")

    return messages.agg(
        F.count(F.lit(1)).alias("events"),
        count_if(F.coalesce(has_sale & unknown, F.lit(False))).alias("unknown_key_events"),
        count_if(F.coalesce(bad_ts, F.lit(False))).alias("bad_ts_events"),
        count_if(F.coalesce(qty < 0, F.lit(False))).alias("negative_qty_events"),
        count_if(F.coalesce(anomaly, F.lit(False))).alias("anomaly_events"),
        F.round(F.avg(n), 2).cast("decimal(12,2)").alias("avg_bytes"),
        F.min(n).alias("min_bytes"),
        F.max(n).alias("max_bytes"))


def partition_spread(messages: DataFrame, partition_col: str = "partition") -> DataFrame:
    """Events per source partition (the stream should use at least two)."""
    return messages.groupBy(partition_col).agg(F.count(F.lit(1)).alias("events"))
