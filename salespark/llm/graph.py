"""Connected components on DataFrames: alternating large-star / small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Every step is a map-side-combined ``min`` per node and one equi-join.  Both join
inputs are checkpointed tables, so adaptive execution can split the rows of a
hub node over several tasks.  No neighbour list is ever built, nothing is broadcast.  A graph whose edges fit one file (``FILE_ROWS``) is
one task's work in each step, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import FILE_ROWS, cut, let_go, unsized


def _stars(edges: DataFrame, both: bool, n: int) -> DataFrame:
    """One step.  ``edges``: (u, v) with u > v, ``n`` of them; a step never makes more.

    large-star (``both``): with m(x) the least of x and its neighbours, every
    neighbour y > x is hung on m(x).  small-star: every smaller neighbour of x,
    and x itself, is hung on x's least neighbour."""
    if both:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    if 2 * n <= FILE_ROWS:
        hung = near.coalesce(1).withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
    else:
        least = unsized(cut(near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m")), 2 * n))
        hung = near.join(least.hint("merge"), F.col("u") == F.col("x"))  # never by a broadcast, which passes through the driver
    if both:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return unsized(cut(out.where("u <> v").groupBy("u", "v").agg(F.lit(1).alias("n")).select("u", "v"), 2 * n))


def _digest(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40)).alias("s")).first()
    return r["n"], r["s"] or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge.

    ``edges``: any two columns of one orderable type, first end and second end;
    direction, repeats, self-loops and rows with a null end don't matter.  An
    empty table gives an empty result.  The number of rounds grows with the
    logarithm of the longest path, not with the data."""
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = unsized(cut(e.groupBy("u", "v").agg(F.lit(1).alias("n")).select("u", "v")))
    before = _digest(e)
    n = before[0]
    while before[0]:
        e = _stars(_stars(e, True, n), False, n)
        after = _digest(e)
        if after == before:
            break
        before = after
        let_go(e.sparkSession)
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return unsized(cut(e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), 2 * n))
