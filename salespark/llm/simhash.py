"""SimHash near-duplicates by a segment-popcount embedding.

1. Fingerprint: majority bits of the XXH64 hashes of a text's word shingles
   (Arrow batches; a text is read whole).
2. Embedding: the 64 bits are cut into 32 segments of two bits and each segment is
   mapped to its bit count 0, 1 or 2.  Moving one fingerprint bit moves one
   count by one, so the Manhattan distance of two embeddings never exceeds the
   Hamming distance of the fingerprints.  The counts are kept in unary code (0 = 00,
   1 = 01, 2 = 11); in that code the Manhattan distance is the bit count of
   an exclusive or.
3. Grid range-join: the embedding is split in ``parts`` halves; of a distance of
   at most 3, one half has at most 1.  Each half is a grid cell, and a cell
   joins itself and the cells one step away.  One step changes the parity of
   the counts' sum, so only points of even sum probe their neighbours and each
   pair meets once per half.
4. Pairs within Manhattan distance are verified on the fingerprints, all inside the join
   condition; only true links leave the join.  Documents of equal fingerprint
   are grouped before it.
5. Connected components of the links (``graph.components``).

Nulls and short texts: a null or wordless text has fingerprint zero and is linked
like any other; a text with fewer words than a shingle is one shingle.  Repeated
rows are all returned.  A null id is returned with its group's component (null
if the group has no other id).  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, small_enough
from .graph import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
HALVES = 2
SEGMENTS = 16  # two-bit segments in a half
CHUNK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of UTF-8 text."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z; \x20 and \x09-\x0D
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= k:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    join, digest, n = b" ".join, xxhash.xxh64_intdigest, len(words) - k + 1
    shingles = map(join, zip(*(words[i:] for i in range(k))))
    ones = np.zeros(64, np.int64)
    left = n
    while left:
        m = min(left, CHUNK)
        h = np.fromiter((digest(s, SEED) for s, _ in zip(shingles, range(m))), np.uint64, m)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(m, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        left -= m
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 k: int = SHINGLE_WORDS) -> DataFrame:
    """(id, key, fp): the hash of the text, and the fingerprint as a signed 64-bit integer; one row per input row."""
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("key"),
                     F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), k) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(fps.view(np.int64))], ["id", "key", "fp"])

    return rows.mapInArrow(run, f"id {id_type}, key long, fp long")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


_LOW = 0x5555555555555555


def unary_counts(fp: Column) -> Column:
    """The 32 two-bit segment counts in unary code, as one 64-bit value."""
    high = F.shiftrightunsigned(fp, 1)
    low = F.lit(_LOW)
    some = fp.bitwiseOR(high).bitwiseAND(low)       # count of 1 or more
    two = fp.bitwiseAND(high).bitwiseAND(low)       # count of 2
    return some.bitwiseOR(F.shiftleft(two, 1))


def _half(code: Column, i: int) -> Column:
    return F.shiftrightunsigned(code, 32 * i).bitwiseAND(F.lit(0xFFFFFFFF))


def _neighbours(cell: Column) -> Column:
    """Cells one step away: each segment's count plus or minus one."""
    steps = []
    for i in range(SEGMENTS):
        some, two = F.lit(1 << (2 * i)), F.lit(2 << (2 * i))
        steps.append(F.when(cell.bitwiseAND(two) == 0, cell.bitwiseXOR(some)))  # 0 <-> 1
        steps.append(F.when(cell.bitwiseAND(some) != 0, cell.bitwiseXOR(two)))  # 1 <-> 2
    return F.array_compact(F.array(*steps))


def links(groups: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): the ``node`` values of all pairs of rows whose ``fp`` differ in ``max_bits``
    or fewer bits, each pair once or twice.  ``groups``: (fp, node), ``fp`` distinct."""
    if max_bits > 2 * HALVES - 1:
        raise ValueError("two halves with one step each reach a distance of 3")
    code = groups.select("fp", "node", unary_counts(F.col("fp")).alias("code"))
    cells = code.select("fp", "node", "code", F.posexplode(F.array(*(_half(F.col("code"), i) for i in range(HALVES))))
                        .alias("half", "cell"))
    even = F.bit_count("cell") % 2 == 0
    around = F.concat(F.array("cell"), F.when(even, _neighbours(F.col("cell"))).otherwise(F.array().cast("array<bigint>")))
    probes = cells.select(F.col("fp").alias("a"), F.col("node").alias("a_node"), F.col("code").alias("a_code"),
                          F.col("half").alias("a_half"), F.posexplode(around).alias("step", "a_cell"))
    manhattan = F.bit_count(F.col("a_code").bitwiseXOR(F.col("code")))
    hamming = F.bit_count(F.col("a").bitwiseXOR(F.col("fp")))
    return probes.join(cells, (F.col("a_half") == F.col("half")) & (F.col("a_cell") == F.col("cell"))
                       & ((F.col("step") > 0) | (F.col("a") < F.col("fp")))
                       & (manhattan <= max_bits) & (hamming <= max_bits)) \
        .select(F.col("a_node").alias("a"), F.col("node").alias("b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, key, fp, component, class) of every row; key: hash of the text; component: the least id of all rows
    reachable over links of ``max_bits`` or fewer differing bits; class: a value that all of these share, whether
    they have ids or not."""
    fps = cut(fingerprints(df, id_col, text_col, k))
    # nodes order by the least id of a fingerprint's rows, so the least node of a
    # component holds its least id; fingerprints without an id come last
    node = F.struct(F.col("first").isNull().alias("no_id"), "first", "fp").alias("node")
    groups = cut(fps.groupBy("fp").agg(F.min("id").alias("first")).select("fp", node))
    parts = cut(components(links(groups, max_bits)).select(
        F.col("node.fp").alias("g"), F.col("component").alias("least")))
    classes = cut(groups.join(parts, F.col("fp") == F.col("g"), "left").select(
        F.col("fp").alias("h"), F.when(F.col("g").isNull(), F.col("node")).otherwise(F.col("least")).alias("class")))
    return fps.join(classes, F.col("fp") == F.col("h"), "left").select(
        "id", "key", "fp", F.col("class.first").alias("component"), "class")


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000,
                   **how) -> DataFrame:
    """One row of each group of near copies, the one of the least id (then least hash of its text; rows without id
    come last), all columns unchanged.  Rows of equal id and text count as one."""
    found = cut(near_duplicates(df, id_col, text_col, **how).select(
        "class", F.struct(F.col("id").isNull().alias("no_id"), "id", "key").alias("row")))
    rows = cut(found.groupBy("class", "row").agg(F.count("*").alias("n")))
    keep = cut(rows.groupBy(F.col("class").alias("c")).agg(F.min("row").alias("best")))
    drop = cut(rows.join(keep, F.col("class") == F.col("c")).where(F.col("row") != F.col("best")).select(
        F.col("row.id").alias("drop_id"), F.col("row.key").alias("drop_key")))
    left = df.join(small_enough(drop, broadcast_rows), df[id_col].eqNullSafe(drop["drop_id"])
                   & (F.xxhash64(df[text_col]) == drop["drop_key"]), "left_anti")
    if rows.where("n > 1").isEmpty():
        return left
    key = fresh(df, "text_key")
    return left.withColumn(key, F.xxhash64(text_col)).dropDuplicates([id_col, key]).drop(key)
