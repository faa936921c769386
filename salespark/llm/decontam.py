"""Benchmark decontamination: a prefix-filtered set join on word shingles, built from
DataFrame operations only.

An item is cut into windows of ``window`` consecutive words (a shorter item is one
window); a window is the set of its positioned five-word shingles (shorter
windows: one shingle, the whole window).

1. Every document position's shingle is joined to the benchmark's shingle dictionary.
   The dictionary is broadcast only below ``broadcast_rows`` rows (counted first); a
   larger one is joined by a shuffle.  What is left, the occurrences, is small and
   checkpointed.
2. Shingles are ordered by rarity, their number of occurrences in all documents.  An
   occurrence of a window holds all of its shingles, so the necessary prefix of
   the ordered set is one token: the window's rarest shingle.  Windows with a shingle that never
   occurs are dropped here.
3. Occurrences of prefix tokens give candidates (document, start, window), bounded by
   position (start >= 0) and length (start + length <= the document's words).
4. A candidate is verified exactly: each of its shingles must occur, as text, at its place
   within that item-sized stretch of the document.

Defined results: a null text has no words; a document without hits has counts of zero and
an empty item list; items without id or without words take no part; repeated
items count once; repeated documents are each returned; extra columns are ignored; an empty benchmark
hits nothing, and empty documents give no rows.  A null document id is kept as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, cut, let, small_enough

WINDOW = 13
SHINGLE = 5
BROADCAST_ROWS = 500_000
#: contaminated: at least one word hit and at least 1 in 20 words
SHARE = 20

_SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """Lower-cased words: runs of ASCII letters, digits and non-ASCII characters."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + _SEPARATORS, UPPER.lower() + " " * len(_SEPARATORS))
    return F.array_remove(F.split(plain, " "), "")


def _shingles(w: Column, k: int) -> Column:
    """Text of the ``k`` words from each position on (none: an empty array)."""
    return let(w, lambda ws: F.transform(
        F.when(F.size(ws) >= k, F.sequence(F.lit(1), F.greatest(F.size(ws) - k + 1, F.lit(1))))
        .otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(ws, i, k), " ")))


def _windows(items: DataFrame, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """(item, length, parts): an item's windows; parts: its shingles in order."""
    w = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w"))
    w = w.where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    part = F.least(F.col("length"), F.lit(k))
    return w.select("item", length.alias("length"), F.col("w")).select("item", "length", F.explode(let(
        F.col("w"), lambda ws: F.transform(
            F.sequence(F.lit(1), F.size(ws) - F.col("length") + 1),
            lambda at: F.transform(F.sequence(F.lit(0), F.col("length") - part),
                                   lambda j: F.array_join(F.slice(ws, at + j, part), " "))))).alias("parts"))


def occurrences(docs: DataFrame, dictionary: DataFrame, short: list[int], k: int, small: bool) -> DataFrame:
    """(doc, text_key, n_words, pos, sid): where a dictionary shingle stands in a document."""
    w = docs.select("doc", "text_key", words(F.col("text")).alias("w"))
    parts = [F.struct(F.lit(n).alias("k"), _shingles(F.col("w"), n).alias("s")) for n in [*short, k]]
    each = w.select("doc", "text_key", F.size("w").alias("n_words"), F.explode(F.array(*parts)).alias("p")) if short else \
        w.select("doc", "text_key", F.size("w").alias("n_words"), parts[0].alias("p"))
    at = each.select("doc", "text_key", "n_words", F.posexplode("p.s").alias("pos", "s"))
    return at.join(F.broadcast(dictionary) if small else dictionary, F.col("s") == F.col("shingle")) \
        .select("doc", "text_key", "n_words", "pos", "sid")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  k: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc, text_key, n_words, n_hit, items, contaminated), one row per input row.

    items: sorted array of the item ids (as text) with an occurring window."""
    # rows are told apart by id and text; equal rows have equal results
    keyed = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("text_key"),
                        F.col(text_col).alias("text"))
    per_item = _windows(items, item_col, item_text, window, k)
    windows = cut(per_item.groupBy("length", "parts").agg(F.collect_set("item").alias("items")).select(
        F.monotonically_increasing_id().alias("win"), "length", "parts", "items"))
    dictionary = cut(windows.select(F.explode("parts").alias("shingle")).distinct().select(
        "shingle", F.monotonically_increasing_id().alias("sid")))
    placed = cut(windows.select("win", "length", F.posexplode("parts").alias("off", "shingle"))
                 .join(dictionary, "shingle").select("win", "length", "off", "sid"))
    # at most k - 1 values
    short = sorted(r[0] for r in windows.where(F.col("length") < k).select("length").distinct().collect())
    small = dictionary.count() <= broadcast_rows

    found = occurrences(keyed, dictionary, short, k, small)
    # equal rows (same id and text) give equal occurrences: keep one
    found = cut(found.groupBy("doc", "text_key", "pos", "sid").agg(F.first("n_words").alias("n_words")))

    rarity = found.groupBy("sid").agg(F.count("*").alias("freq"))
    ranked = placed.join(rarity, "sid", "left").groupBy("win", "length").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "off", "sid")).alias("rarest"))
    prefix = cut(ranked.where("rarest.freq > 0").select("win", "length", "rarest.off", "rarest.sid"))

    cand = found.join(prefix, "sid").select(
        "doc", "text_key", "n_words", (F.col("pos") - F.col("off")).alias("start"), "win", "length") \
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    need = cand.join(placed.select(F.col("win").alias("w2"), F.col("off"), F.col("sid").alias("need_sid")),
                     F.col("win") == F.col("w2")) \
        .select("doc", "text_key", "start", "win", "length", (F.col("start") + F.col("off")).alias("at"), "need_sid")
    have = found.select(F.col("doc").alias("d2"), F.col("text_key").alias("t2"), "pos", "sid")
    held = need.join(have, F.col("d2").eqNullSafe(F.col("doc")) & (F.col("t2") == F.col("text_key"))
                     & (F.col("pos") == F.col("at")) & (F.col("sid") == F.col("need_sid"))) \
        .groupBy("doc", "text_key", "start", "win", "length").agg(F.count("*").alias("n")) \
        .where(F.col("n") == F.col("length") - F.least(F.col("length"), F.lit(k)) + 1)
    spans = cut(held.select("doc", "text_key", "start", "win", "length"))

    hit = spans.select("doc", "text_key", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("length") - 1)).alias("at")).distinct() \
        .groupBy("doc", "text_key").agg(F.count("*").alias("n_hit"))
    named = spans.join(windows.select("win", "items"), "win") \
        .select("doc", "text_key", F.explode(F.col("items").cast("array<string>")).alias("item")).distinct() \
        .groupBy("doc", "text_key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = cut(hit.join(named, hit["doc"].eqNullSafe(named["doc"]) & (hit["text_key"] == named["text_key"])).select(
        hit["doc"].alias("hit_doc"), hit["text_key"].alias("hit_key"), "n_hit", "items"))

    counted = keyed.select("doc", "text_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = counted.join(hits, F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("text_key") == F.col("hit_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc", "text_key", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          broadcast_rows: int = 1_000_000, **how) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, all columns unchanged."""
    found = contamination(docs, items, id_col, text_col, **how)
    drop = cut(found.where("contaminated").select(F.col("doc").alias("drop_id"), F.col("text_key").alias("drop_key")).distinct())
    return docs.join(small_enough(drop, broadcast_rows), docs[id_col].eqNullSafe(drop["drop_id"])
                     & (F.xxhash64(docs[text_col]) == drop["drop_key"]), "left_anti")
