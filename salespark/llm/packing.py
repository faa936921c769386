"""Packing into optimal length buckets with token-budget batches.

1. Sequences: a document's tokens, cut into stretches of ``MAX_LENGTH`` where it is longer; every token is in
   exactly one sequence.
2. The global histogram of sequence lengths, at most ``MAX_LENGTH`` rows, goes to the driver, where dynamic
   programming chooses the ``BUCKETS`` boundaries that minimise the total padding exactly.
3. A bucket's batches hold budget // boundary sequences (one at least).  Sequences are dealt into shards of about
   ``SHARD_ROWS`` by hash, many for a large bucket; they are numbered in their shard, and the running sum of the
   shard sizes gives each its place in the bucket.  So all batches of a bucket but its last are full, and no task
   holds a bucket.

Defined results: a null or empty text is its end token alone; rows with equal id and text are numbered one after
another; a null id is kept; extra columns are ignored; an empty table gives no rows.  Of equally good boundaries
the shorter ones are taken.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

MAX_LENGTH = 4096
BUCKETS = 16
TOKEN_BUDGET = 65_536
SHARD_ROWS = 2_000


def tokens(text: Column) -> Column:
    """Words between white space, and one end token."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(blank, " "), "")) + 1


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """The upper ends of at most ``buckets`` buckets over the distinct, ascending ``lengths`` that
    minimise the padding sum(count * (upper end - length)).

    best[k][j] = min over i < j of best[k-1][i] + length[j-1] * (C[j] - C[i]) - (S[j] - S[i]) with C and S the running
    sums of counts and tokens."""
    h = len(lengths)
    if not h:
        return []
    c = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    s = np.concatenate([[0], np.cumsum(counts * lengths, dtype=np.int64)])
    far = np.iinfo(np.int64).max // 4
    best = np.full(h + 1, far)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, h)):
        new, cut_at = np.full(h + 1, far), np.zeros(h + 1, np.int64)
        new[0] = 0
        for j in range(1, h + 1):
            cost = best[:j] + lengths[j - 1] * (c[j] - c[:j]) - (s[j] - s[:j])
            cut_at[j] = int(np.argmin(cost))
            new[j] = cost[cut_at[j]]
        best = new
        cuts.append(cut_at)
    out, j = [], h
    for cut_at in reversed(cuts):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(cut_at[j])
    return out[::-1]


def sequences(df: DataFrame, id_col: str, length: Column, key: Column, max_length: int) -> DataFrame:
    """(id, key, chunk, start, length): a document's stretches."""
    d = df.select(F.col(id_col).alias("id"), key.alias("key"), length.alias("n"))
    last = F.greatest(F.ceil(F.col("n") / max_length).cast("int") - 1, F.lit(0))
    each = d.select("id", "key", "n", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    start = F.col("chunk") * max_length
    return each.select("id", "key", "chunk", start.alias("start"), F.least(F.col("n") - start, F.lit(max_length)).alias("length"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
         max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, chunk, start, length, bucket, batch, slot) of every sequence; bucket: its padded length; batch: the
    number of its batch in the bucket; slot: its place in the batch.  ``length``: tokens of a row, at least 1."""
    length = tokens(F.col(text_col)) if length is None else length
    # row deals repeated rows over shards; the checkpoint keeps it
    seqs = cut(sequences(df, id_col, length, F.xxhash64(F.col(text_col)), max_length).withColumn("row", F.monotonically_increasing_id()))
    hist = seqs.groupBy("length").count().toPandas().sort_values("length")  # at most max_length rows
    lengths, counts = hist["length"].to_numpy(np.int64), hist["count"].to_numpy(np.int64)
    ends = boundaries(lengths, counts, buckets)
    if not ends:
        return seqs.select("id", "chunk", "start", "length", F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("batch"),
                           F.lit(0).cast("long").alias("slot"))
    bucket, shards, room = F.lit(ends[-1]), F.lit(1), F.lit(1)
    low = 0
    for e in ends:
        n = int(counts[(lengths > low) & (lengths <= e)].sum())
        shards = F.when(F.col("bucket") == e, max(1, -(-n // shard_rows))).otherwise(shards)
        room = F.when(F.col("bucket") == e, max(1, budget // e)).otherwise(room)
        low = e
    for e in reversed(ends[:-1]):
        bucket = F.when(F.col("length") <= e, e).otherwise(bucket)
    dealt = seqs.withColumn("bucket", bucket).withColumn(
        "shard", F.pmod(F.xxhash64("id", "key", "chunk", "row"), shards.cast("long")))
    sizes = dealt.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("bucket").alias("b"), F.col("shard").alias("s"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("bucket", "shard").orderBy("id", "key", "chunk", "row")
    at = dealt.withColumn("no", F.row_number().over(order)).join(
        offsets, (F.col("bucket") == F.col("b")) & (F.col("shard") == F.col("s")))
    place = (F.col("offset") + F.col("no") - 1).alias("place")
    return at.select("id", "chunk", "start", "length", "bucket", place, room.alias("room")) \
        .select("id", "chunk", "start", "length", "bucket", F.expr("place div room").alias("batch"),
                (F.col("place") % F.col("room")).alias("slot"))
