"""Valid events -> ``fact_sales`` rows, with first-arrival-wins on ``sale_id``.

The original job inserts each valid event with ``ON CONFLICT (sale_id) DO
NOTHING``: the first arrival of a sale id is kept, later ones are dropped.

``first_wins`` is one aggregation keyed by ``sale_id`` whose buffer is the smallest ``(ingest_key, row)`` struct of the
columns that are wanted, and no others.  Spark runs it partial-then-final:
every map task already reduces its duplicates of a key to one row before the
shuffle, so a hot sale id (a duplicate storm holding a third of the input)
ships one row per map task, not its whole group -- unlike ``row_number()``
over a window, which would sort the whole hot group inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespark.operators import quality as Q
from salespark.schemas import FACT_COLUMNS


def first_wins(df: DataFrame, key: str = "sale_id", order: str = "ingest_key",
               columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` (unique per arrival), with ``columns`` (all others if not
    given) beside the key."""
    rest = [c for c in (df.columns if columns is None else columns) if c not in (key, order)]
    won = df.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_w"))
    return won.select(key, *[F.col(f"_w.{c}").alias(c) for c in (order, *rest)])


def fact_rows(valid: DataFrame) -> DataFrame:
    """Tagged valid events -> typed fact rows: ``date_id``, hour, minute and weekday are those of the clock on the
    event's text, ``event_timestamp`` is the instant (UTC).  A value that does not fit its column is NULL here
    and breaks the table's contract: see ``by_contract``."""
    return valid.select(
        "sale_id", "user_id", "product_id",
        F.to_date("date_id").alias("date_id"),
        "quantity", "unit_price", "total_amount", "value_band",
        F.col("sale_hour").cast("int").alias("sale_hour"),
        F.col("sale_minute").cast("int").alias("sale_minute"),
        "day_of_week",
        F.col("event_instant").alias("event_timestamp"),
        "ingest_key")


def by_contract(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the NOT NULL columns of the fact table, the others with the names of the ``violations``)."""
    return Q.split_by_rules(rows, Q.not_null_rules(FACT_COLUMNS))


def by_table_contract(rows: DataFrame, dims: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the whole contract of the fact table, the others with the names of the ``violations``): NOT NULL columns,
    CHECK rules (with the bands that are emitted, low/medium/high) and foreign keys into ``dims``."""
    marked, keys = Q.with_foreign_keys(rows, dims)
    checks = {n: r for n, r in Q.fact_rules().items() if n != "value_band_in_schema"}
    ok, bad = Q.split_by_rules(marked, {**Q.not_null_rules(FACT_COLUMNS), **checks, **keys})
    marks = [c for c in marked.columns if c not in rows.columns]
    return ok.drop(*marks), bad.drop(*marks)


def fact_sales(valid: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``fact_sales`` as the consumer table holds it: NOT NULL columns, one
    row per sale id, first arrival wins; ``columns``: those wanted beside ``sale_id``."""
    return first_wins(by_contract(fact_rows(valid))[0], columns=columns)
