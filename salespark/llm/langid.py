"""Language identification: averaged hashed subword embeddings, a linear softmax, and
calibrated rejection.

Features: the letters of a text in lower case, every run of other characters being one
word boundary; all character n-grams (n up to 4) inside a word and across its
boundaries are hashed to ``BUCKETS`` rows of an embedding table, whose mean goes
through a linear softmax.  Whole texts are read, in blocks of bounded memory.

Training: stochastic gradient descent in numpy on a bounded sample, at most about
``SAMPLE_ROWS`` labelled rows, spread evenly over the languages (a row is taken when
the hash of its id falls below its language's share, so the sample is the same
on every run).  One row in five is set aside: it fits the softmax temperature
and the rejection threshold.

Rejection: a text is rejected when it has no letter, or when its calibrated
confidence is below the threshold, the ``FALSE_REJECTS`` quantile of the
confidences of correctly recognised texts set aside, and never above ``MOST_THRESHOLD``, so that clean texts stay.

Defined results: a null text, or one without letters, gets ``und``, score 0 and
is rejected; equal logits go to the language that sorts first; with nothing to learn from every text
gets ``und`` and score 0, and only texts without letters are rejected.  Rows
without id or language are never learned from.  Extra columns are kept by ``keep`` and
ignored otherwise; an empty table gives no rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

BUCKETS_LOG2 = 14
BUCKETS = 1 << BUCKETS_LOG2
DIM = 16
NGRAMS = 4
SAMPLE_ROWS = 3000
EPOCHS = 10
RATE = 0.5
SEED = 42
FALSE_REJECTS = 0.001
MOST_THRESHOLD = 0.4
BLOCK = 1 << 18  # characters hashed at a time
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point 1 for a mark, 2 for a letter, else 0."""
    kinds = {"M": 1, "L": 2}
    return np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)), np.uint8,
                       sys.maxunicode + 1)


def _has_letter(codes: np.ndarray) -> bool:
    return bool((_letters()[codes] == 2).any())


def features(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams, or None for a text without letters."""
    if not text:
        return None
    counts = np.zeros(BUCKETS, np.int64)
    some = False
    tail = np.zeros(1, np.uint64)  # a text begins with a boundary
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at:at + BLOCK].lower().encode("utf-32-le", "replace"), np.uint32)
        kept = np.where(_letters()[codes] > 0, codes, 0)  # marks belong to the n-grams of their letters
        some = some or _has_letter(codes)
        last = at + BLOCK >= len(text)
        run = np.concatenate([tail, kept.astype(np.uint64), np.zeros(int(last), np.uint64)])
        run = run[np.concatenate([[True], (run[1:] != 0) | (run[:-1] != 0)])]  # one boundary for a run of them
        hashed = np.zeros(len(run), np.uint64)
        inside = np.ones(len(run), bool)  # no boundary between the first and the last character
        old = len(tail)  # n-grams that end within the tail are counted already
        for n in range(1, NGRAMS + 1):
            m = len(run) - n + 1
            if m <= 0:
                break
            end = run[n - 1:]
            hashed = hashed[:m] * np.uint64(0x9E3779B97F4A7C15) + end + np.uint64(n)
            if n > 2:
                inside = inside[:m] & (run[n - 2:n - 2 + m] != 0)
            take = inside[:m] & (end != 0) if n == 1 else inside[:m]
            take = take & (np.arange(n - 1, n - 1 + m) >= old)
            mixed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((mixed[take] >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64), minlength=BUCKETS)
        tail = run[-(NGRAMS - 1):]
    return counts if some else None


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: np.ndarray   # BUCKETS x DIM
    weight: np.ndarray  # DIM x languages
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        mean = counts.astype(np.float32) @ self.table / max(1, counts.sum())
        return mean @ self.weight + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)"""
        counts = features(text)
        if counts is None:
            return UNDETERMINED, 0.0, True
        if not self.langs:
            return UNDETERMINED, 0.0, False
        p = _softmax(self.logits(counts) / self.temperature)
        k = int(np.argmax(p))
        return self.langs[k], float(p[k]), bool(p[k] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z.astype(np.float64) - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """``rows``: (language, buckets, counts).  Every fifth row calibrates."""
    langs = tuple(sorted({r[0] for r in rows}))
    rng = np.random.default_rng(SEED)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    if not rows:
        return Model((), table, np.zeros((DIM, 0), np.float32), np.zeros(0, np.float32))
    weight, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    y = np.array([langs.index(r[0]) for r in rows])
    fit = [i for i in range(len(rows)) if i % 5 != 4]
    held = [i for i in range(len(rows)) if i % 5 == 4] or fit
    share = [np.asarray(c, np.float32) / max(1, np.sum(c)) for _, _, c in rows]
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            ids, w, rate = rows[i][1], share[i], np.float32(RATE * (1 - step / steps))
            mean = w @ table[ids]
            g = _softmax(mean @ weight + bias).astype(np.float32)
            g[y[i]] -= 1
            back = weight @ g
            weight -= rate * np.outer(mean, g)
            bias -= rate * g
            table[ids] -= rate * len(ids) ** 0.5 * np.outer(w, back)  # long texts move each row less
            step += 1
    z = np.array([share[i] @ table[rows[i][1]] @ weight + bias for i in held], np.float64)
    t = min(np.geomspace(0.05, 20, 121), key=lambda t: -np.log(_softmax(z / t)[range(len(held)), y[held]] + 1e-300).sum())
    p = _softmax(z / t)
    right = p.max(axis=1)[p.argmax(axis=1) == y[held]]
    threshold = min(MOST_THRESHOLD, float(np.quantile(right, FALSE_REJECTS, method="lower"))) if len(right) else 0.0
    return Model(langs, table, weight, bias, float(t), threshold)


def sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, rows: int) -> list:
    """(language, buckets, counts) of about ``rows`` rows in the order of their ids' hash."""
    d = df.where(learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in d.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()}
    if not sizes:
        return []
    each = max(1, rows // len(sizes))
    keep = F.lit(False)
    for lang, n in sizes.items():  # the hash is even over 64 bits
        keep = keep | ((F.col("lang") == lang) & (F.col("h") <= min(2**63 - 1, int(-2**63 + min(1.0, each / n) * 2**64))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(h, g, f) for h, g, f in zip(b.column("h").to_pylist(), b.column("lang").to_pylist(),
                                                  map(features, b.column("text").to_pylist())) if f is not None]
            # at most 6 bytes for each of the buckets
            ids = [np.flatnonzero(f) for _, _, f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string()),
                pa.array([i.astype(np.uint16).tobytes() for i in ids], pa.binary()),
                pa.array([x[2][i].astype(np.uint32).tobytes() for x, i in zip(found, ids)], pa.binary()),
            ], ["h", "lang", "ids", "counts"])

    got = d.where(keep).mapInArrow(counted, "h long, lang string, ids binary, counts binary") \
        .orderBy("h", "lang", "counts").limit(2 * rows).collect()
    return [(r["lang"], np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["counts"], np.uint32)) for r in got]


def fit(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = SAMPLE_ROWS) -> Model:
    """A model from the rows of ``df`` for which ``learn`` holds."""
    return train(sample(df, id_col, text_col, lang_col, learn, rows))


def predict(model: Model, text: Column) -> Column:
    """struct(lang, score, rejected) of each text."""
    @F.pandas_udf("lang string, score double, rejected boolean")
    def udf(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score", "rejected"])

    return udf(text)


def keep(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text isn't rejected, all columns unchanged."""
    tag = fresh(df, "language")
    return df.withColumn(tag, predict(model, F.col(text_col))).where(~F.col(tag)["rejected"]).drop(tag)
