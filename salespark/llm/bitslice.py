"""Exact top-k inner products with a bit-sliced index (O'Neil and Quass, 1997; Rinfret et al., 2001).

Vectors are quantised to integers, floor(scale * x), and dealt into blocks by the hash of their id and row.  In a block each
component is stored as bit slices: slice b of a component is a bitmap with bit b of every
row's value (less the component's least value).  For a query,

* the score of all rows at once is a sum of slices: where bit j of the query's component is set, its slices are
  added in at weight j (complemented slices if the query's component is negative, with a constant set
  right afterwards); columns of equal weight are reduced by bitmap full adders, three slices to a sum and a
  carry, until one slice of each weight is left;
* the top rows are selected from the most significant slice downward: the rows surely in, and the rows
  still equal to the boundary;
* boundary rows with equal scores are resolved by the smaller id.

The stated queries meet all rows in blocks: a pair of a row block and a query block is one group, bounded by
``BLOCK_ROWS`` and ``QUERY_ROWS``, and returns k rows for each query.  A second step ranks those per query.

Defined results: a vector that is null or holds a null or non-finite component takes no part, nor does a null id; vectors of different
lengths are not compared; every row of another id is a candidate, so repeated rows are each found; a query is an id (one that several
rows have is searched with each of their vectors, and its best rows are ranked together); a query with
fewer than k candidates gets them all; extra columns are ignored; an empty table gives no rows.  A vector with a component
over ``LARGEST`` / sqrt(length), after scaling, takes no part either: its inner products need not fit 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SCALE = 64
K = 20
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
BLOCK_BYTES = 1 << 26  # of a block's vectors as integers: long vectors come in smaller blocks
LARGEST = math.isqrt((1 << 63) - 1)  # bound of a vector's length in integers


class Slices:
    """A block's bit-sliced index.  ``values``: rows x components, integers; rows in order of id."""

    def __init__(self, values: np.ndarray):
        self.rows, self.dims = values.shape
        words = (self.rows + 63) // 64
        self.least = values.min(axis=0) if self.rows else np.zeros(self.dims, np.int64)
        u = values - self.least
        self.width = int(u.max()).bit_length() if u.size else 0
        bits = np.zeros((self.dims, self.width, words * 64), np.uint8)
        for b in range(self.width):
            bits[:, b, :self.rows] = ((u >> b) & 1).T
        self.slices = self._pack(bits)
        all_rows = np.zeros(words * 64, np.uint8)
        all_rows[:self.rows] = 1
        self.all = self._pack(all_rows)

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view("<u8")

    def scores(self, q: np.ndarray) -> tuple[np.ndarray, int]:
        """(slices of a sum by weight, constant): a row's score is its sum plus the constant."""
        size, negative = np.abs(q), q < 0
        use = np.flatnonzero(size)
        signed = self.slices[use] ^ np.where(negative[use], ~np.uint64(0), np.uint64(0))[:, None, None]
        columns: list[list[np.ndarray]] = []
        for j in range(int(size.max(initial=0)).bit_length()):
            part = signed[(size[use] >> j) & 1 == 1]
            for b in range(self.width):
                while len(columns) <= j + b:
                    columns.append([])
                columns[j + b].append(part[:, b])
        out, p = [], 0
        while p < len(columns):
            rest = np.concatenate(columns[p]) if columns[p] else np.zeros((1, len(self.all)), np.uint64)
            while len(rest) > 1:
                m = len(rest) // 3
                if m:
                    a, b, c = rest[:m], rest[m:2 * m], rest[2 * m:3 * m]
                    odd = a ^ b
                    carry = (a & b) | (odd & c)
                    rest = np.concatenate([odd ^ c, rest[3 * m:]])
                else:
                    carry = (rest[0] & rest[1])[None]
                    rest = (rest[0] ^ rest[1])[None]
                if p + 1 == len(columns):
                    columns.append([])
                columns[p + 1].append(carry)
            out.append(rest[0] if len(rest) else np.zeros(len(self.all), np.uint64))
            p += 1
        constant = int((q.astype(object) * self.least.astype(object)).sum()) \
            - int(size[negative].astype(object).sum()) * ((1 << self.width) - 1) if self.dims else 0
        return np.array(out, np.uint64).reshape(len(out), len(self.all)), constant

    def top(self, q: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(row numbers, scores) of the ``k`` highest scores, equal ones by row number; ``own``: rows
        that take no part."""
        total, constant = self.scores(q)
        rest = self.all.copy()
        for r in own:
            rest[r // 64] &= ~(np.uint64(1) << np.uint64(r % 64))
        sure = np.zeros_like(rest)
        n_sure, n_rest = 0, int(np.bitwise_count(rest).sum())
        for s in total[::-1]:
            if n_sure + n_rest <= k:
                break
            high = rest & s
            n = int(np.bitwise_count(high).sum())
            if n_sure + n > k:
                rest, n_rest = high, n
            else:
                sure, n_sure = sure | high, n_sure + n
                rest, n_rest = rest & ~s, n_rest - n
        rows = np.concatenate([self._numbers(sure), self._numbers(rest)[:k - n_sure]])
        bits = (total[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
        scores = [sum(1 << p for p in np.flatnonzero(bits[:, i]).tolist()) + constant for i in range(len(rows))]
        return rows, scores

    @staticmethod
    def _numbers(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, row, v): the integer vectors that take part; row tells repeated rows apart."""
    x = F.col(vec_col).cast("array<double>")
    bound = F.lit(float(LARGEST) / scale) / F.sqrt(F.greatest(F.size(x), F.lit(1))) - 1
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= bound))
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine) \
        .select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def _search(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t["id"].to_numpy()
        flat = t["v"].combine_chunks().flatten().to_numpy()
        order = np.argsort(ids, kind="stable")
        return ids[order], flat.reshape(len(ids), -1 if len(flat) else 0)[order]

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and queries.num_rows:
            ids, values = matrix(rows)
            block = Slices(values)
            for qid, q in zip(*matrix(queries)):
                at, scores = block.top(q, k, np.flatnonzero(ids == qid))
                found[0].extend([qid] * len(at))
                found[1].extend(ids[at].tolist())
                found[2].extend(scores)
        return pa.table([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"])

    return run


def top_k(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query with the rows
    of other ids.  ``is_query``: a condition on the column ``id``."""
    rows = cut(quantised(df, id_col, vec_col, scale))
    n = rows.agg(F.count("*").alias("rows"), F.count(F.when(is_query, 1)).alias("queries"), F.max(F.size("v")).alias("dims")).first()
    block_rows = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, n["dims"] or 0))))
    blocks, parts = max(1, -(-n["rows"] // block_rows)), max(1, -(-n["queries"] // query_rows))

    def dealt(d: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return d.select("id", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("id", "row"), F.lit(n_own)).alias(own),
                        F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)).cast("array<bigint>")).alias(other))

    left = dealt(rows, "block", blocks, "part", parts).groupBy("dims", "block", "part")
    right = dealt(rows.where(is_query), "part", parts, "block", blocks).groupBy("dims", "block", "part")
    best = left.cogroup(right).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
