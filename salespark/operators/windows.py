"""Sliding-window sales statistics (30 s windows every 10 s by default).

The original job aggregates the whole valid stream in one non-keyed window
operator (parallelism 1) with a ``[count, sum]`` accumulator.  Here the window
itself is the grouping key: Spark expands each row into its 3 windows, sums
partially inside every map task, then shuffles one partial row per (task,
window) -- no single task ever sees the whole stream.

Statistics per window: ``sale_count`` counts every event (an absent amount is
counted and adds 0), ``total_revenue`` is the decimal sum and
``avg_order_value`` the cent-rounded decimal mean (``avg()`` would skip NULLs).  The amount is ``total_value``, which
holds totals that do not fit the fact table too.  Counts and sums merge: ``merged`` adds up partial rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespark.functions import money as M
from salespark.schemas import MONEY_SUM

# Window length and slide of the aggregation job.
WINDOW_LENGTH = "30 seconds"
WINDOW_SLIDE = "10 seconds"


def _revenue() -> F.Column:
    return F.sum(F.coalesce(F.col("total_value"), F.lit(0).cast(MONEY_SUM)))


def _statistics(rev: F.Column) -> list[F.Column]:
    return ["sale_count", rev.cast(MONEY_SUM).alias("total_revenue"),
            M.mean_cents(rev, F.col("sale_count")).alias("avg_order_value")]


def window_stats(valid: DataFrame, time_col: str, length: str = WINDOW_LENGTH,
                 slide: str = WINDOW_SLIDE) -> DataFrame:
    agg = (valid.groupBy(F.window(time_col, length, slide).alias("w"))
                .agg(F.count(F.lit(1)).alias("sale_count"), _revenue().alias("_rev")))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *_statistics(F.col("_rev")))


#: Windows a task combines before it passes them on.
HELD_WINDOWS = 50_000


def partial_rows(events: DataFrame, time_col: str, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE) -> DataFrame:
    """Partial rows that each task has combined from its own rows, without a shuffle: what a stream in append mode can give.
    ``merged`` adds them up.  A task holds at most ``HELD_WINDOWS`` windows and the rows of one Arrow batch."""
    members = (events.select(F.window(time_col, length, slide).alias("w"), "total_value")
               .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       F.lit(1).cast("long").alias("sale_count"),
                       F.coalesce(F.col("total_value"), F.lit(0)).cast(MONEY_SUM).alias("_rev")))
    schema = f"window_start timestamp_ntz, window_end timestamp_ntz, sale_count long, _rev {MONEY_SUM.simpleString()}"
    return members.mapInArrow(_combine, schema).select("window_start", "window_end", *_statistics(F.col("_rev")))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = _sums(rows if held is None else pa.concat_tables([held, rows]))
        if held.num_rows > HELD_WINDOWS:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()


def _sums(rows: pa.Table) -> pa.Table:
    sums = rows.group_by(["window_start", "window_end"]).aggregate([("sale_count", "sum"), ("_rev", "sum")])
    return pa.table([sums[c] for c in ("window_start", "window_end", "sale_count_sum", "_rev_sum")], names=rows.column_names).cast(rows.schema)


def merged(partial: DataFrame) -> DataFrame:
    """One row per window from partial rows of disjoint sets of events."""
    agg = partial.groupBy("window_start", "window_end").agg(
        F.sum("sale_count").alias("sale_count"), F.sum("total_revenue").alias("_rev"))
    return agg.select("window_start", "window_end", *_statistics(F.col("_rev")))


def empty_guarded(valid: DataFrame) -> DataFrame:
    """Whole-input statistics with the empty guard: no rows -> zeros.

    A global aggregate always yields one row; sums over nothing are NULL and
    become 0, and the mean of nothing is 0 (never a division by zero)."""
    agg = valid.agg(F.count(F.lit(1)).alias("sale_count"),
                    _revenue().alias("_rev"))
    rev = F.coalesce(F.col("_rev"), F.lit(0)).cast(MONEY_SUM)
    return agg.select("sale_count", rev.alias("total_revenue"),
                      M.mean_cents(rev, F.col("sale_count")).alias("avg_order_value"))
