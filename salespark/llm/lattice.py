"""Language-model score by subword lattice likelihood.

An existing subword vocabulary weights all segmentations of a text: a unigram
model over its pieces, whose forward recursion in log space sums the probability of every
segmentation.  Words are lower-cased and separated by white space; a word starts
with the vocabulary's word mark and no piece crosses it, so a text's
marginal probability is the product of its words' marginals and the end
symbol's.  The lattice is therefore walked once per distinct word, not per token.

Scores: a file whose scores are log probabilities is used as it is; scores that are merge
ranks (whole numbers) become Zipf weights, 1 / (1 + rank).  Those existing weights
are the prior; ``EM_PASSES`` rounds of expectation-maximisation over the
learning texts' word counts adapt them (the vocabulary itself is never changed).  Characters
without a piece are spelled by byte pieces.

Jobs: (1) word counts, combined per batch before the shuffle; (2) one pass over the distinct words
for each expectation step, which sends each partition's sums per piece; (3) one
pass that scores the distinct words; (4) the documents again: words that make up at least
one ``1 / FREQUENT`` of all tokens -- there are at most ``FREQUENT`` such words -- are looked up
in a broadcast table, all others are joined by a shuffle, where no word
can hold more than that share of the rows.

The base score is an add-one unigram word model over the same counts:
log10((c + 1) / (N + V + 1)) for each token, the end symbol being a token.

Defined results: a null or empty text has only the end symbol; repeated rows are all
returned; rows without id are scored and never learned from; with nothing to learn from the
prior weights stand and every base probability is 1 / (N + V + 1) = 1; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
EM_PASSES = 3
PRIOR_COUNTS = 100.0
FREQUENT = 200_000
LONG = 48      # characters from which a word goes by itself
TOGETHER = 4096  # words of one length at a time
FLUSH = 200_000  # distinct words, or rows, held before they are sent on


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _codes(strings: list[str], n: int) -> np.ndarray:
    """Code points (position x string) of strings of one length."""
    flat = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    return np.ascontiguousarray(flat.reshape(len(strings), n).T).astype(np.uint64) + np.uint64(1)


def _hash(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(codes.shape[1], np.uint64)
    for row in codes:
        h = h * _FACTOR + row
    return h


class Lattice:
    """Pieces with log probabilities.  ``trie`` has every prefix of a piece: its number, or -1."""

    def __init__(self, pieces: list[str], log_p: np.ndarray, byte_of: dict[int, int], end: float):
        self.pieces, self.log_p, self.byte_of, self.end = pieces, log_p, byte_of, end
        self.trie: dict[str, int] = {}
        spelled = set(byte_of.values())
        by_length: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            if k in spelled:
                continue
            for n in range(1, len(p)):
                self.trie.setdefault(p[:n], -1)
            self.trie[p] = k
            by_length.setdefault(len(p), []).append(k)
        self.single = {p for p in pieces if len(p) == 1}
        #: for each length, the pieces' hashes in order and their numbers
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, ids in by_length.items():
            h = _hash(_codes([pieces[k] for k in ids], n))
            self.tables[n] = h[np.argsort(h)], np.array(ids)[np.argsort(h)]

    def __getstate__(self):
        return self.pieces, self.log_p, self.byte_of, self.end

    def __setstate__(self, state):
        self.__init__(*state)

    def arcs(self, s: str, i: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """(end, log probability, pieces) of the pieces that start at ``i``."""
        out, j, n, get, lp = [], i + 1, len(s), self.trie.get, self.log_p
        while j <= n:
            k = get(s[i:j])
            if k is None:
                break
            if k >= 0:
                out.append((j, lp[k], (k,)))
            j += 1
        if self.trie.get(s[i], -1) < 0:
            ids = tuple(self.byte_of[b] for b in s[i].encode())
            out.append((i + 1, sum(lp[k] for k in ids), ids))
        return out

    def forward(self, s: str) -> list[float]:
        """Natural log of the probability of each prefix, over all its segmentations."""
        n, exp, log = len(s), math.exp, math.log
        into: list[list[float] | None] = [None] * (n + 1)
        alpha = [-math.inf] * (n + 1)
        alpha[0] = 0.0
        for i in range(n + 1):
            xs = into[i]
            if xs is not None:
                if len(xs) == 1:
                    alpha[i] = xs[0]
                else:
                    m = max(xs)
                    alpha[i] = m + log(sum([exp(x - m) for x in xs])) if m > -math.inf else m
                into[i] = None
            if i == n:
                break
            a = alpha[i]
            for j, lp, _ in self.arcs(s, i):
                if into[j] is None:
                    into[j] = [a + lp]
                else:
                    into[j].append(a + lp)
        return alpha

    def words(self, ws: list[str], counts: list[int] | None = None, into: np.ndarray | None = None) -> np.ndarray:
        """Natural log of the marginal probability of each word.  With ``counts``, add
        the expected number of each piece to ``into``.

        The recursion runs over many words of one length at a time; words with characters that
        have no piece, and long ones, go one by one."""
        out = np.empty(len(ws))
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(ws):
            if len(w) < LONG and self.single.issuperset(w):
                groups.setdefault(len(w), []).append(i)
            else:
                out[i] = self.forward(MARK + w)[-1] if counts is None else self.expect(w, counts[i], into)
        for n, idx in groups.items():
            idx.sort(key=ws.__getitem__)
            for at in range(0, len(idx), TOGETHER):
                part = idx[at:at + TOGETHER]
                out[part] = self._block(_codes([MARK + ws[i] for i in part], n + 1),
                                        None if counts is None else np.array([counts[i] for i in part], float), into)
        return out

    def _block(self, codes: np.ndarray, counts: np.ndarray | None, into: np.ndarray | None) -> np.ndarray:
        log_p = np.asarray(self.log_p)
        n, m = codes.shape
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0
        spans = []
        for i in range(n):
            h = np.zeros(m, np.uint64)
            for j in range(i + 1, min(n, i + max(self.tables)) + 1):
                h = h * _FACTOR + codes[j - 1]
                if j - i not in self.tables:
                    continue
                hashes, ids = self.tables[j - i]
                pos = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = np.flatnonzero(hashes[pos] == h)
                if len(hit):
                    k = ids[pos[hit]]
                    alpha[j, hit] = np.logaddexp(alpha[j, hit], alpha[i, hit] + log_p[k])
                    spans.append((i, j, hit, k))
        if counts is not None:
            beta = np.full((n + 1, m), -np.inf)
            beta[n] = 0
            for i, j, hit, k in reversed(spans):
                after = log_p[k] + beta[j, hit]
                p = np.exp(alpha[i, hit] + after - alpha[n, hit])
                into += np.bincount(k, p * counts[hit], minlength=len(into))
                beta[i, hit] = np.logaddexp(beta[i, hit], after)
        return alpha[n]

    def expect(self, w: str, count: float, into: np.ndarray) -> float:
        """Add ``count`` times the expected number of each piece in the word; its log probability."""
        s = MARK + w
        alpha = self.forward(s)
        total, n = alpha[-1], len(s)
        beta = [-math.inf] * (n + 1)
        beta[n] = 0.0
        for i in range(n - 1, -1, -1):
            arcs = self.arcs(s, i)
            xs = [lp + beta[j] for j, lp, _ in arcs]
            m = max(xs)
            beta[i] = m + math.log(sum([math.exp(x - m) for x in xs])) if m > -math.inf else m
            for (_, _, ids), x in zip(arcs, xs):
                p = math.exp(alpha[i] + x - total)
                if p > 1e-12:
                    for k in ids:
                        into[k] += count * p
        return total


def vocabulary(path: str = VOCABULARY) -> Lattice:
    """A lattice with the existing scores of a SentencePiece file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, byte_of = [], [], {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or (len(p) > 1 and not p.strip(MARK)):
            continue
        if sp.is_byte(i):
            byte_of[int(p[1:-1], 16)] = len(pieces)
        pieces.append(p)
        scores.append(sp.get_score(i))
    z = np.array(scores)
    spelled = np.zeros(len(z), bool)
    spelled[list(byte_of.values())] = True
    if (z == np.round(z)).all():
        z = -np.log(1 - z)  # ranks: Zipf's law
    z[spelled] = z[~spelled].min()  # byte pieces have no score of their own
    end = -math.log(len(pieces) + 1)
    return Lattice(pieces, z - np.logaddexp.reduce(z) + math.log1p(-math.exp(end)), byte_of, end)


def _tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # both ASCII only


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, n): a word's number in the learning texts and in all.  ``docs``: (learn, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, learned = Counter(), Counter()

        def out() -> pa.RecordBatch:
            words = list(seen)
            return pa.RecordBatch.from_arrays([
                pa.array(words, pa.binary()).cast(pa.string()), pa.array([learned[w] for w in words], pa.int64()),
                pa.array([seen[w] for w in words], pa.int64())], ["word", "c", "n"])

        for b in batches:
            for learn, text in zip(b.column("learn"), b.column("text")):
                words = _tokens(text.as_py())
                seen.update(words)
                if learn.as_py():
                    learned.update(words)
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
                    learned.clear()
        yield out()

    return docs.select("learn", F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "word string, c long, n long") \
        .groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = FLUSH) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``, so that a batch has many words of each length."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def adapt(prior: Lattice, words: DataFrame, texts: int, passes: int = EM_PASSES) -> Lattice:
    """Piece probabilities after ``passes`` rounds of expectation-maximisation over the word
    counts (word, c); ``texts``: how many texts ended."""
    model = prior
    for _ in range(passes):
        def run(batches: Iterator[pa.RecordBatch], m: Lattice = model) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(m.pieces))
            for b in _gathered(batches):
                m.words(b.column("word").to_pylist(), b.column("c").to_pylist(), sums)
            ids = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums[ids])], ["piece", "x"])

        got = words.where("c > 0").select("word", "c").mapInArrow(run, "piece long, x double") \
            .groupBy("piece").agg(F.sum("x").alias("x")).collect()  # at most one row per piece
        sums = np.zeros(len(prior.pieces))
        for r in got:
            sums[r["piece"]] = r["x"]
        total = sums.sum() + texts + PRIOR_COUNTS
        p = (sums + PRIOR_COUNTS * np.exp(prior.log_p)) / total
        model = Lattice(prior.pieces, np.log(p), prior.byte_of,
                        math.log((texts + PRIOR_COUNTS * math.exp(prior.end)) / total))
    return model


def score_words(model: Lattice, words: DataFrame) -> DataFrame:
    """(word, c, n, lp): with the log10 of each word's marginal probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _gathered(batches):
            lp = pa.array(model.words(b.column("word").to_pylist()) / math.log(10))
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), b.column("n"), lp], ["word", "c", "n", "lp"])

    return words.select("word", "c", "n").mapInArrow(run, "word string, c long, n long, lp double")


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          path: str = VOCABULARY, passes: int = EM_PASSES, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score), one row per input row;
    ``learn``: which rows to learn from."""
    rows = docs.select(F.col(id_col).alias("id"), learn.alias("learn"), F.col(text_col).cast("binary").alias("text"))
    words = cut(word_counts(rows))
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                     F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    texts = rows.where("learn").count()
    n_train, v = sums["c"] + texts, sums["v"] + (texts > 0)
    all_log = math.log10(n_train + v + 1)
    model = adapt(vocabulary(path), words, texts, passes)
    scored = cut(score_words(model, words))
    often = {r["word"].encode(): (r["c"], r["lp"]) for r in
             scored.where(F.col("n") * frequent >= sums["n"]).select("word", "c", "lp").collect()}
    end_base, end_lp = math.log10(texts + 1) - all_log, model.end / math.log(10)
    table = docs.sparkSession.sparkContext.broadcast(
        {w: (c > 0, math.log10(c + 1) - all_log, lp) for w, (c, lp) in often.items()})
    id_type = rows.schema["id"].dataType.simpleString()
    names = ["id", "key", "word", "tf", "rows", "n", "known", "base", "lp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = table.value
        for b in batches:
            cols: tuple[list, ...] = tuple([] for _ in names)
            ids, keys = b.column("id"), b.column("key").to_pylist()

            def out() -> pa.RecordBatch:
                at, key, word, tf, ones, n, known, base, lp = cols
                return pa.RecordBatch.from_arrays([
                    ids.take(pa.array(at, pa.int64())), pa.array(key, pa.int64()), pa.array(word, pa.binary()).cast(pa.string()),
                    pa.array(tf, pa.int64()), pa.array(ones, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(lp, pa.float64())], names)

            for i, text in enumerate(b.column("text")):
                tokens = _tokens(text.as_py())
                known, base, lp = int(texts > 0), end_base, end_lp
                rare = []
                for w, k in Counter(tokens).items():
                    hit = known_words.get(w)
                    if hit is None:
                        rare.append((w, k))
                    else:
                        known += k * hit[0]
                        base += k * hit[1]
                        lp += k * hit[2]
                for c, x in zip(cols, (i, keys[i], None, 0, 1, len(tokens) + 1, known, base, lp)):
                    c.append(x)
                m = len(rare)
                for c, x in zip(cols, ([i] * m, [keys[i]] * m, [w for w, _ in rare], [k for _, k in rare],
                                       [0] * m, [0] * m, [0] * m, [0.0] * m, [0.0] * m)):
                    c.extend(x)
                if len(cols[0]) > FLUSH:
                    yield out()
                    for c in cols:
                        c.clear()
            if cols[0]:
                yield out()

    parts = rows.select("id", F.xxhash64("text").alias("key"), "text").mapInArrow(
        run, f"id {id_type}, key long, word string, tf long, rows long, n long, known long, base double, lp double")
    # the sums over frequent words pass the join unmatched, each under a key of its own (no word has a space)
    parts = parts.withColumn("word", F.coalesce("word", F.concat(F.lit(" "), F.col("key").cast("string"))))
    joined = parts.join(scored.select(F.col("word").alias("w"), "c", F.col("lp").alias("word_lp")),
                        F.col("word") == F.col("w"), "left")
    c = F.coalesce("c", F.lit(0))
    total = joined.groupBy("id", "key").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"),
        F.sum(F.col("known") + F.when(c > 0, F.col("tf")).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.when(F.col("tf") > 0, F.col("tf") * (F.log10(c + 1) - all_log)).otherwise(0.0)).alias("base"),
        F.sum(F.col("lp") + F.when(F.col("tf") > 0, F.col("tf") * F.col("word_lp")).otherwise(0.0)).alias("lp"))
    # equal rows (same id and text) were summed together
    each = total.select("id", "rows", F.explode(F.sequence(F.lit(1), F.col("rows"))), "n", "known", "base", "lp")
    return each.select("id", F.expr("n div rows").alias("n_tokens"), F.expr("known div rows").alias("n_known"),
                       F.lit(n_train).cast("long").alias("train_tokens"),
                       (F.col("base") / F.col("rows")).alias("base_score"), (F.col("lp") / F.col("rows")).alias("score"))
