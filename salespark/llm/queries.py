"""The registered queries of the corpus operators: thin wrappers that apply an
operator with production parameters to its whole table and derive the result
columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, read


def held_out(rest: int, m: int = 3) -> Column:
    """Whether crc32(doc_id as text) mod ``m`` is ``rest``; rows without id count as
    held out, so nothing is learned from them."""
    return F.coalesce(crc_mod(F.col("doc_id"), m) == rest, F.lit(True))


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs, learn=~held_out(1))
    found = docs.select("doc_id", held_out(1).alias("held_out"), langid.predict(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                        F.col("p.rejected").alias("rejected"))


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quotes
    return quotes.conversations(read(spark, sf_dir, "conversations")).withColumnsRenamed(
        {"conv": "conv_id", "parent": "parent_turn", "root": "root_turn"})


def quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2's operator where there is something to link: each message but a conversation's first also quotes the first line
    of the message one or two turns before it."""
    from . import quotes
    talk = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    earlier = talk.groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t")).agg(F.min("text").alias("quoted"))
    back = F.greatest(F.col("turn") - 1 - (F.col("conv_id") + F.col("turn")) % 2, F.lit(0))
    mail = talk.join(earlier, (F.col("conv_id") == F.col("c")) & (F.col("t") == back) & (F.col("turn") > 0), "left")
    line = F.get(F.split("quoted", "\n"), F.lit(0))
    quoting = mail.select("conv_id", "turn", "role", F.concat_ws("\n", F.concat(F.lit("> "), line), "text").alias("text"))
    return quotes.conversations(quoting).select(
        F.col("conv").alias("conv_id"), "turn", F.col("parent").alias("parent_turn"), "n_quotes", "text")


QUOTE_THREADS_SQL = r"""
WITH talk AS (SELECT conv_id, turn, text FROM conversations),
back AS (
  SELECT a.conv_id, a.turn, a.text, string_split(min(b.text), chr(10))[1] AS quoted
  FROM (SELECT *, row_number() OVER () AS n FROM talk) a
  LEFT JOIN talk b ON a.conv_id = b.conv_id AND a.turn > 0 AND b.turn = greatest(a.turn - 1 - (a.conv_id + a.turn) % 2, 0)
  GROUP BY a.n, a.conv_id, a.turn, a.text),
lines AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM talk),
paragraphs AS (
  SELECT conv_id, turn, replace(unnest(string_split_regex(text, '
 *
')), chr(10), ' ') AS line FROM talk),
units AS (
  SELECT conv_id, turn, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS u FROM (FROM lines UNION ALL FROM paragraphs)),
firsts AS (SELECT conv_id, u, min(turn) AS parent FROM units GROUP BY ALL)
SELECT b.conv_id, b.turn, CASE WHEN f.parent < b.turn THEN f.parent END AS parent_turn,
       CAST(CASE WHEN trim(quoted) <> '' THEN 1 ELSE 0 END AS BIGINT) AS n_quotes, trim(b.text) AS text
FROM back b LEFT JOIN firsts f ON f.conv_id = b.conv_id AND f.u = trim(regexp_replace(lower(b.quoted), '\s+', ' ', 'g'))
  AND trim(b.quoted) <> ''
"""


def op3_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bitslice
    return bitslice.top_k(read(spark, sf_dir, "embeddings"), is_query=F.col("id") % 20 == 0)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash
    docs = read(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), learn=~held_out(1))
    found = docs.select("doc_id", held_out(1).alias("held_out"), quality.score(model, F.col("text")).alias("score"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontam
    found = decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import linededup
    return linededup.classes(read(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"), "line_no", F.col("class.doc").alias("class_doc_id"),
        F.col("class.line_no").alias("class_line_no"), "kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing
    return packing.pack(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secret_scan as S
    found = S.scan(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(S.written(F.col("base")).cast("binary"), 256).alias("base_sha256"), S.written(F.col("spans")).alias("spans"))


def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lattice
    docs = read(spark, sf_dir, "documents")
    held = held_out(2, 7)
    return lattice.score(docs, learn=~held).select(
        F.col("id").alias("doc_id"), F.coalesce(crc_mod(F.col("id"), 7) == 2, F.lit(True)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import trie
    turns, convs = trie.spliced(trie.numbered(read(spark, sf_dir, "conversations")), every=20, most=4)
    return trie.nodes(turns, convs).withColumnsRenamed({"conv": "conv_id", "parent_conv": "parent_conv_id"})


OP11_SQL = r"""
WITH o AS (
  SELECT conv_id AS c, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT c, list({'role': role, 'text': text} ORDER BY pos) AS u FROM o GROUP BY c),
crc AS (  -- crc32 bit by bit over the decimal digits
  SELECT c, u, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
    lambda a, d: list_reduce(list_prepend(xor(a, d), range(8)),
      lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) % 4 AS h
  FROM own),
b AS (
  SELECT x.c, list_concat(coalesce(y.u[1 : x.h], []), x.u[x.h + 1 : len(x.u)]) AS u
  FROM crc x LEFT JOIN own y ON y.c = x.c - x.c % 20),
p AS (
  SELECT c, d, len(u) = d AS ended, CASE WHEN d > 0 THEN u[d].text ELSE '' END AS t,
         CASE WHEN d = 0 THEN '' ELSE sha256(to_json(u[1 : d])) END AS key
  FROM (SELECT c, u, unnest(range(len(u) + 1)) AS d FROM b)),
n AS (
  SELECT d, key, min(c) AS c, count(*) AS n, len(regexp_extract_all(any_value(t), '[^\x20\x09-\x0D]+')) AS words,
         sha256(coalesce(string_agg(CASE WHEN ended THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends
  FROM p GROUP BY d, key),
above AS (  -- the node itself and those above it
  SELECT n.d, n.key, n.words * (n.n - 1) AS saving, q.d AS ad, q.key AS akey FROM n JOIN p q ON q.c = n.c AND q.d <= n.d),
kids AS (SELECT ad AS d, akey AS key, count(*) AS k FROM above WHERE ad = d - 1 GROUP BY ALL),
subtree AS (
  SELECT ad AS d, akey AS key, sum(saving) AS saving, count(*) FILTER (kids.k IS NULL) AS leaves
  FROM above LEFT JOIN kids USING (d, key) GROUP BY ALL),
parent AS (SELECT x.d, x.key, y.c FROM above x JOIN n y ON y.d = x.ad AND y.key = x.akey WHERE x.ad = x.d - 1)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, parent.c AS parent_conv_id, n.n AS n_convs, coalesce(kids.k, 0) AS n_children,
       CAST(subtree.leaves AS BIGINT) AS n_leaves, CAST(subtree.saving AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN subtree USING (d, key) LEFT JOIN kids USING (d, key) LEFT JOIN parent USING (d, key)
"""


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fim
    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)
    return fim.fill_in_middle(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents),
k AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS UBIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS UBIGINT) % (len(u) + 1) AS b,
         CAST('0x' || h[17:24] AS UBIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS UBIGINT) % 100 AS h4
  FROM d),
p AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 100 THEN 'plain'
                            WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1 : least(a, b)], '') AS x, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1 : n], '') AS s
  FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || x || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || x || '<M>' || m
                        ELSE t END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def op13_kdsearch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import kdsearch
    return kdsearch.nearest(read(spark, sf_dir, "embeddings"), is_query=F.col("id") % 20 == 0)


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, w, least(len(w), 13) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL) WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS win
  FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM i)),
dw AS (
  SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)),
occ AS (SELECT doc_id, p, k, item_id FROM dw JOIN iw USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_quotes": op2_quotes,
    "op3_bitslice": op3_bitslice,
    "quote_threads": quote_threads,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_decontam": op6_decontam,
    "op7_lines": op7_lines,
    "op8_packing": op8_packing,
    "op9_secrets": op9_secrets,
    "op10_lattice": op10_lattice,
    "op11_trie": op11_trie,
    "op12_fim": op12_fim,
    "op13_kdsearch": op13_kdsearch,
}

ORACLES: dict[str, str] = {
    "quote_threads": QUOTE_THREADS_SQL,
    "op3_bitslice": OP3_SQL,
    "op6_decontam": OP6_SQL,
    "op11_trie": OP11_SQL,
    "op12_fim": OP12_SQL,
}
