"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

Tokens: runs of word characters (ASCII letters and digits, all non-ASCII bytes) and runs of
one kind of other character; a word in capitals only is told apart from the same word in lower
case.  Features: hashed indicators of single tokens and pairs of neighbours, and
one for a word that repeats the word before it.

1. Class log-count ratios r = log((p / |p|) / (q / |q|)), p and q being the smoothed counts of the
   indicators in all labelled rows to learn from, of class 1 and 0.  Each task sends its
   counts per bucket, so at most ``BUCKETS`` rows leave a task.
2. Indicators scaled by r, rows scaled to length one, and a linear hinge-loss model fitted by dual
   coordinate descent (Hsieh et al., 2008) on a bounded sample, at most about ``SAMPLE_ROWS``
   rows, half of each class, taken by the hash of their id.
3. One sampled row in five is set aside; a logistic curve through its margins, weighted back to the
   labels' true shares, gives the score.

Labels are few columns of a table that grows with the input; they are broadcast only below
``BROADCAST_ROWS`` rows (counted first) and joined by a shuffle above.

Defined results: a null or empty text has no features and gets the score of the bias; a document with several
labels has the class of their mean (one half counts as 1); null labels are no labels; with one class
only, or none, every text gets the smoothed share of label 1.  Rows without id are never learned from.
Repeated rows are each returned; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS_LOG2 = 16
BUCKETS = 1 << BUCKETS_LOG2
SAMPLE_ROWS = 3000
BROADCAST_ROWS = 1_000_000
ALPHA = 1.0       # smoothing of the counts
COST = 1.0        # C of the hinge loss
EPOCHS = 30
SEED = 42
BLOCK = 1 << 20   # bytes of a text hashed at a time

_FACTOR = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE, _WORD = 0, 1
#: kind of each byte: white space, word, or its own kind of sign
_KIND = np.array([_SPACE if c <= 0x20 else _WORD if c >= 0x80 or chr(c).isalnum() else c for c in range(256)], np.uint8)
_POWERS = np.cumprod(np.full(64, _FACTOR))  # of a character's place in a token, the last one from there on


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return ((h ^ (h >> np.uint64(29))) * _MIX >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)


def _blocks(text: bytes) -> Iterator[bytes]:
    """Cut at white space, so that no token is cut unless it is longer than a block."""
    at = 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        if end < len(text):
            space = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            end = space + 1 if space > at else end
        yield text[at:end]
        at = end


def features(text: bytes | None) -> np.ndarray:
    """The distinct buckets of a text's indicators, in order."""
    found, last = [np.zeros(0, np.int64)], np.zeros(0, np.uint64)
    for block in _blocks(text or b""):
        raw = np.frombuffer(block, np.uint8)
        kind = _KIND[raw]
        edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        size = np.diff(np.concatenate([edge, [len(raw)]]))
        place = np.arange(len(raw)) - np.repeat(edge, size)
        low = np.frombuffer(block.lower(), np.uint8)
        value = (low.astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(place, len(_POWERS) - 1)]
        h = np.add.reduceat(value, edge) if len(edge) else np.zeros(0, np.uint64)
        capitals = np.add.reduceat((raw != low).astype(np.int64), edge)
        kind = kind[edge]
        h = h + ((kind == _WORD) & (size > 1) & (capitals == size)).astype(np.uint64)
        token = kind != _SPACE
        h, word = np.concatenate([last, h[token]]), np.concatenate([np.full(len(last), False), kind[token] == _WORD])
        found.append(_bucket(h[len(last):]))
        found.append(_bucket(h[:-1] * _FACTOR + h[1:] + np.uint64(7)))
        if ((h[1:] == h[:-1]) & word[1:]).any():
            found.append(_bucket(np.array([11], np.uint64)))
        last = h[-1:]
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # BUCKETS: ratio times the fitted weight
    ratio: np.ndarray
    bias: float
    slope: float        # of the logistic curve
    shift: float

    def score(self, text: bytes | None) -> float:
        z = self.slope * self.margin(features(text)) + self.shift
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def margin(self, ids: np.ndarray) -> float:
        norm = math.sqrt(float((self.ratio[ids] ** 2).sum()))
        return (float(self.weight[ids].sum()) / norm if norm else 0.0) + self.bias


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int,
                            cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the linear hinge-loss (L1) support vector machine; ``rows``: (ids, values); y: +1 or -1."""
    rng = np.random.default_rng(SEED)
    w, alpha = np.zeros(size), np.zeros(len(rows))
    square = np.array([float((v * v).sum()) for _, v in rows])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            ids, v = rows[i]
            if not square[i]:
                continue
            g = y[i] * float(w[ids] @ v) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), cost)
            if new != alpha[i]:
                w[ids] += (new - alpha[i]) * y[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(1) = 1 / (1 + exp(-(slope x + shift))), by damped Newton steps; targets are
    smoothed as by Platt, so that separated classes have a finite curve."""
    n1, n0 = weight[y == 1].sum(), weight[y == 0].sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, math.log((n1 + 1) / (n0 + 1))

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((weight * (np.logaddexp(0, z) - t * z)).sum()) + 1e-6 * (a * a + b * b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        d, h = weight * (p - t), weight * p * (1 - p)
        g = np.array([(d * x).sum() + 2e-6 * a, d.sum() + 2e-6 * b])
        hess = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 2e-6 * np.eye(2)
        step, rate = np.linalg.solve(hess, g), 1.0
        while rate > 1e-6 and loss(a - rate * step[0], b - rate * step[1]) > loss(a, b):
            rate /= 2
        a, b = a - rate * step[0], b - rate * step[1]
        if abs(step).max() * rate < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


def train(ratio: np.ndarray, sample: list[tuple[int, np.ndarray]], share: float) -> Model:
    """``sample``: (class, buckets); ``share``: the true share of class 1."""
    y = np.array([c for c, _ in sample])
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held = np.zeros(len(y), bool)
    if len(set(y)) < 2:
        return Model(np.zeros(BUCKETS), ratio, 0.0, 0.0, math.log(share / (1 - share)))
    scaled = []
    for _, ids in sample:
        v = ratio[ids]
        norm = math.sqrt(float((v * v).sum())) or 1.0
        scaled.append((np.append(ids, BUCKETS), np.append(v / norm, 1.0)))  # the last is the bias
    rows = [r for r, h in zip(scaled, held) if not h]
    w = dual_coordinate_descent(rows, np.where(y[~held] == 1, 1.0, -1.0), BUCKETS + 1)
    use = held if held.any() else ~held
    x = np.array([float(w[ids] @ v) for (ids, v), u in zip(scaled, use) if u])
    n1, n0 = (y[use] == 1).sum(), (y[use] == 0).sum()
    weight = np.where(y[use] == 1, share / n1, (1 - share) / n0) * len(x)
    slope, shift = _logistic(x, y[use], weight)
    return Model(ratio * w[:-1], ratio, float(w[-1]), slope, shift)


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """(h, y, text) of the rows to learn from."""
    y = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")) \
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    d = docs.where(learn & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    y = F.broadcast(y) if labels.count() <= BROADCAST_ROWS else y
    return d.join(y, F.col("id") == F.col("label_id")).select(F.xxhash64("id").alias("h"), "y", "text")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled rows of ``docs`` for which ``learn`` holds."""
    data = labelled(docs, labels, learn, id_col, text_col, label_col)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS + 1), np.int64)  # the last bucket counts rows
        for b in batches:
            for y, text in zip(b.column("y").to_pylist(), b.column("text")):
                n[y, features(text.as_py())] += 1
                n[y, BUCKETS] += 1
        ids = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[0, ids]), pa.array(n[1, ids])], ["bucket", "q", "p"])

    got = data.select("y", "text").mapInArrow(counted, "bucket long, q long, p long").groupBy("bucket") \
        .agg(F.sum("q").alias("q"), F.sum("p").alias("p")).toArrow()  # at most BUCKETS + 1 rows
    n = np.zeros((2, BUCKETS + 1))
    n[0, got["bucket"].to_numpy()] = got["q"].to_numpy()
    n[1, got["bucket"].to_numpy()] = got["p"].to_numpy()
    (n0, n1), counts = n[:, BUCKETS], n[:, :BUCKETS] + ALPHA
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    keep = F.lit(False)
    for y, size in ((0, n0), (1, n1)):  # the hash is even over 64 bits
        share = min(1.0, rows / 2 / max(size, 1))
        keep = keep | ((F.col("y") == y) & (F.col("h") <= min(2**63 - 1, int(-2**63 + share * 2**64))))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [features(t.as_py()).astype(np.uint16).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("y"), pa.array(ids, pa.binary())], ["h", "y", "ids"])

    sample = data.where(keep).mapInArrow(drawn, "h long, y int, ids binary").orderBy("h", "y", "ids").limit(2 * rows).collect()
    return train(ratio, [(r["y"], np.frombuffer(r["ids"], np.uint16).astype(np.int64)) for r in sample],
                 (n1 + 1) / (n0 + n1 + 2))


def score(model: Model, text: Column) -> Column:
    """Probability of label 1 for each text."""
    @F.pandas_udf("double")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return udf(text.cast("binary"))
