"""Approximate nearest neighbours by inner product: low-dimensional stable projections in a kd-tree, searched outwards until a
chi-square test holds (the scheme of SRS: Sun, Wang, Qin, Zhang and Lin, 2014).

Inner product becomes distance: with M the greatest norm, x becomes (x / M, sqrt(1 - |x|^2 / M^2)) and a query (q / |q|, 0); both
have length one, and the nearest are those of greatest inner product.  ``PROJECTED`` independent normal projections of
a difference of length d have a squared length of d^2 times a chi-square variable of ``PROJECTED`` degrees.  So a point nearer
than the k-th found, at d_k, is nearer than r in the projection with probability ``CONFIDENCE`` or more as soon as
r^2 >= quantile * d_k^2: there the search stops (``CONFIDENCE`` bounds the expected recall from below).

1. Equal vectors are one point with its least k + 1 ids (others can't be in an answer), so a vector that a third of all rows
   hold is no hot group.
2. The top of the kd-tree is fitted on the projections of at most ``SAMPLE_ROWS`` points with the least hashes: at most ``CELLS``
   cells of about a block's rows.  Every point goes to its cell; a cell of more than a block is dealt over several blocks.
3. In each block a kd-tree of leaves of ``LEAF`` points is built once and stored as one row with its vectors.
4. A query is searched in its own cell's blocks first, which bounds d_k, then in the blocks of the other cells whose box passes
   the test.  Queries stream past a block's tree in sorted batches, ``PART_QUERIES`` at most to a copy of it.
5. In a tree, boxes that fail the test are left out level by level, from all queries at once; then each query takes its
   leaves from the nearest on, verifies points within the test's radius by their inner product, and stops at the first
   leaf beyond it.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component takes no part, nor does a null id; vectors of
different lengths are not compared; each row of another id is a candidate, repeated rows too; a query is an id with
a vector (repeated rows are one query); a query with fewer than k candidates finds what there is; ties go to the smaller id;
extra columns are ignored; an empty table gives no rows.  Scores beyond the range of double come in no defined order.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, saved

K = 20
PROJECTED = 12         # even: the chi-square distribution then has a closed form
CONFIDENCE = 0.95
SEED = 13
LEAF = 64
BLOCK_ROWS = 8_192
BLOCK_BYTES = 1 << 26  # of a block's vectors, where they are long
SAMPLE_ROWS = 65_536
CELLS = 4_096
PART_QUERIES = 16_384
FIRST_LEAVES = 8       # leaves taken at once, doubled each time
TABLES = "kd-search"
AT = ["dims", "cell", "block"]
QUERY = ["id", "k1", "k2"]


def chi_square(x: float, m: int) -> float:
    """Distribution function for an even number ``m`` of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))


def quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < p else (low, mid)
    return high


@cache
def directions(dims: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims, m]).standard_normal((dims + 1, m))


def projected(x: np.ndarray, largest: float, m: int, seed: int) -> np.ndarray:
    """Of points, whose norms are at most ``largest``."""
    x = x / largest
    up = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
    w = directions(x.shape[1], m, seed)
    return x @ w[:-1] + up[:, None] * w[-1]


def norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(np.square(x / top[:, None]).sum(axis=1))


def projected_queries(q: np.ndarray, m: int, seed: int) -> np.ndarray:
    unit = q / np.abs(q).max(axis=1)[:, None]
    unit /= np.sqrt(np.square(unit).sum(axis=1))[:, None]
    return unit @ directions(q.shape[1], m, seed)[:-1]


def box_distance(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points and boxes."""
    gap = np.maximum(0.0, np.maximum(low - p, p - high))
    return np.einsum("...i,...i->...", gap, gap)


class Splits:
    """The top of the tree: ``depth`` levels of splits at medians of the widest component.  A cell is a number from 0."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.component = np.zeros(1 << depth, np.int64)
        self.at = np.zeros(1 << depth)
        groups = [sample]
        for level in range(depth):
            below = []
            for i, g in enumerate(groups):
                node = (1 << level) + i
                if len(g):
                    c = int(np.argmax(g.max(axis=0) - g.min(axis=0)))
                    self.component[node], self.at[node] = c, np.median(g[:, c])
                right = g[:, self.component[node]] > self.at[node]
                below += [g[~right], g[right]]
            groups = below

    def cells(self, p: np.ndarray) -> np.ndarray:
        node = np.ones(len(p), np.int64)
        rows = np.arange(len(p))
        for _ in range(self.depth):
            node = 2 * node + (p[rows, self.component[node]] > self.at[node])
        return node - (1 << self.depth)


class Tree:
    """A block: vectors in the order of their leaves, their ids (``offset`` into ``ids``), projections, and the boxes of each level."""

    def __init__(self, **arrays: np.ndarray):
        self.x, self.p, self.ids, self.offset, self.starts, self.low, self.high = (
            arrays[c] for c in ("x", "p", "ids", "offset", "starts", "low", "high"))
        self.largest = float(arrays["largest"])
        leaves = len(self.starts) - 1
        self.depth = leaves.bit_length() - 1
        width = int(np.diff(self.starts).max())
        self.rows = self.starts[:-1, None] + np.arange(width)
        self.rows[self.rows >= self.starts[1:, None]] = -1

    @classmethod
    def build(cls, x: np.ndarray, ids: list[np.ndarray], largest: float, m: int, seed: int, leaf: int = LEAF) -> Tree:
        p = projected(x, largest, m, seed)
        depth = max(0, math.ceil(math.log2(max(1, len(x)) / leaf)))
        groups, low, high = [np.arange(len(x))], [], []
        for level in range(depth + 1):
            low += [p[g].min(axis=0) for g in groups]
            high += [p[g].max(axis=0) for g in groups]
            if level == depth:
                break
            below = []
            for g in groups:
                c = int(np.argmax(p[g].max(axis=0) - p[g].min(axis=0)))
                by = np.argpartition(p[g, c], len(g) // 2)
                below += [g[by[:len(g) // 2]], g[by[len(g) // 2:]]]
            groups = below
        order = np.concatenate(groups)
        taken = [ids[i] for i in order]
        return cls(x=x[order], p=p[order], ids=np.concatenate(taken), offset=np.cumsum([0, *map(len, taken)]),
                   starts=np.cumsum([0, *map(len, groups)]), low=np.array(low), high=np.array(high), largest=np.array(largest))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, x=self.x, p=self.p, ids=self.ids, offset=self.offset, starts=self.starts, low=self.low, high=self.high,
                 largest=np.array(self.largest))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**arrays)

    def leaves(self, p: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, leaf, squared distance) of the leaves whose boxes and those above are within the squared ``radius``, each
        query's from the nearest on."""
        query, node = np.arange(len(p)), np.ones(len(p), np.int64)
        for level in range(self.depth + 1):
            if level:
                query, node = np.repeat(query, 2), np.stack([2 * node, 2 * node + 1], axis=1).ravel()
            near = box_distance(p[query], self.low[node - 1], self.high[node - 1])
            keep = near <= radius[query]
            query, node, near = query[keep], node[keep], near[keep]
        order = np.lexsort((near, query))
        return query[order], node[order] - (1 << self.depth), near[order]

    def nearest_leaf(self, p: np.ndarray) -> np.ndarray:
        node = np.ones(len(p), np.int64)
        for _ in range(self.depth):
            both = [box_distance(p, self.low[2 * node - 1 + i], self.high[2 * node - 1 + i]) for i in (0, 1)]
            node = 2 * node + (both[1] < both[0])
        return node - (1 << self.depth)

    def search(self, q: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int, stop: float, m: int, seed: int) -> list[tuple]:
        """(scores, ids) for each query, at most k: ``bound`` is a score that its k-th is known to reach (-inf: none)."""
        p = projected_queries(q, m, seed)
        tops = [Top(k, own[i], bound[i], norm * self.largest) for i, norm in enumerate(norms(q).tolist())]
        first = np.full(len(q), -1)
        open_ = np.flatnonzero(np.isneginf(bound))
        if len(open_):  # a first bound from the leaf at hand
            first[open_] = self.nearest_leaf(p[open_])
            for i in open_.tolist():
                rows = self.rows[first[i]]
                self._verify(tops[i], q[i], rows[rows >= 0])
        query, leaf, near = self.leaves(p, stop * np.array([t.distance for t in tops]))
        ends = np.searchsorted(query, np.arange(len(q) + 1))
        for i, top in enumerate(tops):
            at, end, step = int(ends[i]), int(ends[i + 1]), FIRST_LEAVES
            while at < end and near[at] <= stop * top.distance:
                chosen = leaf[at:min(at + step, end)]
                rows = self.rows[chosen[chosen != first[i]]].ravel()
                rows = rows[rows >= 0]
                gap = self.p[rows] - p[i]
                self._verify(top, q[i], rows[np.einsum("ij,ij->i", gap, gap) <= stop * top.distance])
                at, step = at + step, 2 * step
        return [(t.scores, t.ids) for t in tops]

    def _verify(self, top: Top, q: np.ndarray, rows: np.ndarray) -> None:
        scores = self.x[rows] @ q
        better = scores >= top.least
        rows, scores = rows[better], scores[better]
        if len(rows):
            sizes = self.offset[rows + 1] - self.offset[rows]
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            top.add(np.repeat(scores, sizes), self.ids[np.repeat(self.offset[rows], sizes) + within])


class Top:
    """The best ``k`` so far of a query, ties to the smaller id; its own id left out."""

    def __init__(self, k: int, own: int, bound: float, scale: float):
        self.k, self.own, self.least, self.scale = k, own, bound, scale
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.own
        scores, ids = np.concatenate([self.scores, scores[other]]), np.concatenate([self.ids, ids[other]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(self.least, float(self.scores[-1]))

    @property
    def distance(self) -> float:
        """Squared distance of the k-th, as far as it is known."""
        return math.inf if self.least == -math.inf else max(0.0, 2 - 2 * self.least / self.scale)


def by_length(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for each length of the vectors of a batch."""
    v = batch.column(column)
    sizes = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = v.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        yield n, rows, flat[starts[rows][:, None] + np.arange(n)]


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, k1, k2): the vectors that take part, (k1, k2) the hash of one."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < math.inf)) & F.exists(x, lambda e: e != 0)
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine) \
        .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: e + F.lit(0.0)).alias("v")) \
        .select("id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"))


def points(rows: DataFrame, k: int) -> DataFrame:
    """(k1, k2, v, ids): the distinct vectors with the least k + 1 ids of each; an id as often as its row is repeated, at most k times."""
    once = rows.groupBy("k1", "k2", "id").agg(F.count("*").alias("n"), F.any_value("v").alias("v"))
    least = Window.partitionBy("k1", "k2").orderBy("id")
    few = once.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= k + 1)
    return few.groupBy("k1", "k2").agg(F.any_value("v").alias("v"), F.flatten(F.sort_array(F.collect_list(F.transform(
        F.sequence(F.lit(1), F.least("n", F.lit(k))), lambda _: F.col("id"))))).alias("ids"))


class Plan:
    """What the tasks need to know: for each length of vectors the greatest norm, the splits, the blocks and box of each cell."""

    def __init__(self, m: int, seed: int, stop: float, k: int):
        self.m, self.seed, self.stop, self.k = m, seed, stop, k
        self.largest: dict[int, float] = {}
        self.splits: dict[int, Splits] = {}
        self.blocks: dict[int, np.ndarray] = {}  # of each cell
        self.box: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of the cells that have points
        self.full: dict[int, np.ndarray] = {}  # numbers of those cells

    def place(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(dims, cell, p) of points."""
        for b in batches:
            for n, rows, x in by_length(b):
                p = projected(x, self.largest[n], self.m, self.seed)
                cells = self.splits[n].cells(p) if n in self.splits else np.zeros(len(p), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(pa.array(rows)) for c in ("k1", "k2", "v", "ids")), pa.array(np.full(len(p), n)), pa.array(cells),
                     pa.array(list(p), pa.list_(pa.float64()))], ["k1", "k2", "v", "ids", "dims", "cell", "p"])

    def send(self, home: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Queries to the blocks of their own cell, or to those of the other cells that the test leaves in."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bounds = b.column("bound").to_numpy(zero_copy_only=False)
                for n, rows, q in by_length(b):
                    p = projected_queries(q, self.m, self.seed)
                    own = self.splits[n].cells(p) if n in self.splits else np.zeros(len(p), np.int64)
                    at, cells = np.arange(len(p)), own
                    if not home:
                        scale = norms(q) * self.largest[n]
                        bound = bounds[rows]
                        radius = np.where(np.isneginf(bound), np.inf, self.stop * np.maximum(0.0, 2 - 2 * bound / scale))
                        low, high = self.box[n]
                        near = np.stack([box_distance(p, lo, hi) for lo, hi in zip(low, high)], axis=1)
                        at, which = np.nonzero((near <= radius[:, None]) & (self.full[n][None] != own[:, None]))
                        cells = self.full[n][which]
                    count = self.blocks[n][cells]
                    at, cells = np.repeat(at, count), np.repeat(cells, count)
                    block = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                    for i in range(0, len(at), 4_096):
                        part = slice(i, i + 4_096)
                        take = pa.array(rows[at[part]])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(take), n)), pa.array(cells[part]), pa.array(block[part]),
                             *(b.column(c).take(take) for c in (*QUERY, "v", "bound"))], [*AT, *QUERY, "v", "bound"])
        return run

    def build(self, t: pa.Table) -> pa.Table:
        """A block's tree as one row."""
        n, cell, block = (t[c][0].as_py() for c in AT)
        x = t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, n)
        ids = [np.array(v, np.int64) for v in t["ids"].to_pylist()]
        tree = Tree.build(x, ids, self.largest[n], self.m, self.seed)
        return pa.table({"dims": [n], "cell": [cell], "block": [block], "tree": pa.array([tree.to_bytes()], pa.binary())})

    def search(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block and part, the tree of each first, then its queries."""
        tree = None
        for b in batches:
            kinds = b.column("tree").is_valid().to_numpy(zero_copy_only=False)
            marks = [0, *np.flatnonzero(kinds).tolist(), b.num_rows]
            for lo, hi in zip(marks, marks[1:]):
                if lo == hi:
                    continue
                if kinds[lo]:
                    tree = Tree.from_bytes(b.column("tree")[lo].as_py())
                    lo += 1
                if lo == hi:
                    continue
                asked = b.slice(lo, hi - lo)
                for _, rows, q in by_length(asked):
                    at = pa.array(rows)
                    found = tree.search(q, asked.column("id").take(at).to_numpy(), asked.column("bound").take(at).to_numpy(zero_copy_only=False),
                                        self.k, self.stop, self.m, self.seed)
                    sizes = [len(s) for s, _ in found]
                    again = pa.array(np.repeat(rows, sizes))
                    yield pa.RecordBatch.from_arrays(
                        [*(asked.column(c).take(again) for c in QUERY), pa.array(np.concatenate([i for _, i in found])),
                         pa.array(np.concatenate([s for s, _ in found]))], [*QUERY, "vec_id", "score"])


def fitted(found: DataFrame, k: int, m: int, confidence: float, seed: int, block_rows: int) -> tuple[Plan, DataFrame]:
    """The plan for the points ``found``, and the saved points with their places (dims, cell, block)."""
    plan = Plan(m, seed, quantile(confidence, m), k)
    norm = let(F.array_max(F.transform("v", lambda e: F.abs(e))), lambda top: top * F.sqrt(
        F.aggregate("v", F.lit(0.0), lambda s, e: s + (e / top) * (e / top))))
    sizes = {r["dims"]: r for r in found.groupBy(F.size("v").alias("dims")).agg(F.max(norm).alias("largest"), F.count("*").alias("n")).collect()}
    plan.largest = {n: r["largest"] for n, r in sizes.items()}

    def room(n: int) -> int:
        return max(2 * LEAF, min(block_rows, BLOCK_BYTES // (8 * n)))

    schema = "k1 long, k2 long, v array<double>, ids array<long>, dims long, cell long, p array<double>"
    for n, r in sorted(sizes.items(), key=lambda s: -s[1]["n"]):
        depth = min(CELLS.bit_length() - 1, math.ceil(math.log2(max(1, r["n"] / room(n)))))
        if depth and len(plan.splits) < 16:  # rarer lengths have a single cell
            some = found.where(F.size("v") == n).orderBy("k1", "k2").limit(SAMPLE_ROWS).mapInArrow(plan.place, schema).select("p").collect()
            plan.splits[n] = Splits(np.array([s["p"] for s in some]), depth)
    placed = saved(found.mapInArrow(plan.place, schema), TABLES)
    ends = [f(F.get("p", i)).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(m)]
    cells = placed.groupBy("dims", "cell").agg(F.count("*").alias("n"), *ends).collect()
    for n in sizes:
        own = sorted((c for c in cells if c["dims"] == n), key=lambda c: c["cell"])
        plan.blocks[n] = np.zeros(1 << (plan.splits[n].depth if n in plan.splits else 0), np.int64)
        for c in own:
            plan.blocks[n][c["cell"]] = -(-c["n"] // room(n))
        plan.full[n] = np.array([c["cell"] for c in own], np.int64)
        plan.box[n] = tuple(np.array([[c[f"{f}{i}"] for i in range(m)] for c in own]) for f in ("min", "max"))
    return plan, placed


def nearest(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", m: int = PROJECTED,
            confidence: float = CONFIDENCE, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` rows of other ids with the greatest inner product, as far as they
    are found.  ``is_query``: a condition on the column ``id``."""
    if m % 2 or not 0 < confidence < 1:
        raise ValueError("an even number of projections, and a confidence between 0 and 1")
    rows = usable(df, id_col, vec_col)
    plan, placed = fitted(saved(points(rows, k), TABLES), k, m, confidence, seed, block_rows)
    many = F.create_map(*(F.lit(v) for n, counts in plan.blocks.items() for c, b in enumerate(counts.tolist()) for v in (n * CELLS + c, b))) \
        if plan.blocks else None
    if many is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    per_cell = many[F.col("dims") * CELLS + F.col("cell")]
    trees = saved(placed.withColumn("block", F.pmod(F.xxhash64("k1", "k2"), per_cell)).groupBy(*AT)
                  .applyInArrow(lambda t: plan.build(t), "dims long, cell long, block long, tree binary"), TABLES)
    queries = saved(rows.where(is_query).groupBy(*QUERY).agg(F.any_value("v").alias("v")), TABLES)
    sent = "dims long, cell long, block long, id long, k1 long, k2 long, v array<double>, bound double"
    best = Window.partitionBy(*QUERY).orderBy(F.desc("score"), "vec_id")

    def asked(found: DataFrame) -> DataFrame:
        found = saved(found, TABLES)
        load = found.groupBy(*AT).agg(F.ceil(F.count("*") / PART_QUERIES).cast("long").alias("parts"))
        there = found.join(load, AT).select(*AT, F.pmod(F.xxhash64(*QUERY), "parts").alias("part"), *QUERY, "v", "bound", F.lit(None).cast("binary").alias("tree"))
        copies = trees.join(load, AT).select(*AT, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                                             *(F.lit(None).cast("long").alias(c) for c in QUERY), F.lit(None).cast("array<double>").alias("v"),
                                             F.lit(None).cast("double").alias("bound"), "tree")
        out = copies.union(there).repartition(*AT, "part").sortWithinPartitions(*AT, "part", F.col("tree").isNull()).drop(*AT, "part")
        answers = out.mapInArrow(plan.search, "id long, k1 long, k2 long, vec_id long, score double")
        return saved(answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), TABLES)

    first = asked(queries.withColumn("bound", F.lit(-math.inf)).mapInArrow(plan.send(True), sent))
    bounds = first.where(F.col("rank") == k).select(*QUERY, F.col("score").alias("bound"))
    more = asked(queries.join(bounds, QUERY, "left").withColumn("bound", F.coalesce("bound", F.lit(-math.inf))).mapInArrow(plan.send(False), sent))
    return first.union(more).drop("rank").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
