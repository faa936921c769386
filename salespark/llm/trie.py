"""Prefix trie of conversations, built as a burst trie (Heinz, Zobel and Williams, 2002).

A conversation is its sequence of turns, a turn's id is the 128-bit hash of its role and text.  A trie node is a distinct
sequence of first turns; its members are the conversations that start with it.

1. ``numbered`` gives every turn its position.  Turns are sorted by range over the whole table and counted
   per conversation and range, so a conversation that holds a third of all turns is sorted in many tasks.
2. ``nodes`` puts all conversations in one container under the root's head.  A container of more than ``burst_rows`` rows
   bursts: its head follows the turns that its members share to the first position where they part (their number by position is
   one aggregation, so long common beginnings, and groups of copies, cost one round however long they are), and the
   suffixes behind go to new containers by next turn id.  Rounds end when no container is oversized.
3. The remaining containers are dealt over shards of about ``shard_rows`` rows.  In a shard each container's suffixes are sorted
   and swept: neighbours' common beginnings give the nodes, from the last to the first their counts.
4. The heads' nodes are counted from the deepest round up: each takes the sums of the containers under it.

Conversations' ids that end at a node are hashed in sorted order; for a head's node they stream through one task in
sorted batches, and only a running digest is held.

Defined results: turns are in order of turn (null first), then role and text, repeated turns stay; a null role or text is empty;
rows without a conversation id take no part; an empty table has no nodes, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, saved

BURST_ROWS = 8_192   # rows that a container may hold before it bursts
SHARD_ROWS = 65_536  # rows of containers swept together
BLOCK = 4_096        # positions of a head whose sums are taken in one window
TABLES = "trie"
HEAD = ["g1", "g2"]
OUT = ("conv long, depth long, parent_conv long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
       "ends_sha256 string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, pos, k1, k2, words): each turn with its position from 0, its id, and its words, as a saved table."""
    rows = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "row"]  # row: repeated rows may be dealt over ranges too
    ordered = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.monotonically_increasing_id().alias("at"), F.xxhash64("role", "text").alias("k1"),
        F.xxhash64(F.lit(1), "role", "text").alias("k2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")), TABLES) \
        .withColumn("part", F.shiftright("at", 33))
    # a conversation is contiguous in each range that it reaches
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = ordered.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("at").alias("first")) \
        .select(F.col("conv").alias("c"), F.col("part").alias("p"), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return saved(ordered.join(spans, (F.col("conv") == F.col("c")) & (F.col("part") == F.col("p")))
                 .select("conv", (F.col("at") + F.col("shift")).alias("pos"), "k1", "k2", "words"), TABLES)


def positions(turns: DataFrame, convs: DataFrame | None) -> DataFrame:
    """(conv, pos, k1, k2, words): a row for each turn and one behind the last, with the id of the turn at the position (null: the
    conversation has ended) and the words of the turn before it."""
    null = F.lit(None).cast("long")
    rows = turns.select("conv", "pos", "k1", "k2", null.alias("words")).union(
        turns.select("conv", F.col("pos") + 1, null, null, "words"))
    if convs is not None:
        rows = rows.union(convs.select("conv", F.lit(0).cast("long"), null, null, null))
    return rows.groupBy("conv", "pos").agg(*(F.max(c).alias(c) for c in ("k1", "k2", "words")))


def sha_of_ends() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows (g1, g2, pos, conv) sorted by all of them: one row (g1, g2, pos, ends_sha256) for each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*HEAD, "pos", "ends_sha256"]
        node, digest = None, None
        for b in batches:
            done = []
            keys = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            convs = b.column(3).to_pylist()
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                text = ",".join(map(str, convs[lo:hi])).encode()
                key = tuple(keys[lo].tolist())
                if key == node:
                    digest.update(b"," + text)
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], names)
    return run


def swept(members: list[tuple[list, list, int]], depth: int, parent_conv: int | None) -> list[tuple]:
    """The nodes of a container, its top first.  ``members``: (turn ids behind the head, words of the turn before each position,
    conversation), sorted.  ``depth`` of the top; a node is (conv, depth, parent_conv, n, children, leaves, saved, digest)."""
    parents, depths, words, ends = [-1], [depth], [members[0][1][0] or 0], [[]]
    path, before = [0], []
    for turns, sizes, conv in members:
        same, most = 0, min(len(before), len(turns))
        while same < most and before[same] == turns[same]:
            same += 1
        del path[same + 1:]
        for d in range(same, len(turns)):
            parents.append(path[-1])
            depths.append(depth + d + 1)
            words.append(sizes[d + 1] or 0)
            ends.append([])
            path.append(len(parents) - 1)
        ends[path[-1]].append(conv)
        before = turns
    k = len(parents)
    n, children, leaves, saving, least = [0] * k, [0] * k, [0] * k, [0] * k, [None] * k
    for i in range(k - 1, -1, -1):  # children come behind their parent
        n[i] += len(ends[i])
        if ends[i] and (least[i] is None or ends[i][0] < least[i]):
            least[i] = ends[i][0]
        leaves[i] = leaves[i] or 1
        saving[i] += (n[i] - 1) * words[i]
        p = parents[i]
        if p >= 0:
            n[p] += n[i]
            children[p] += 1
            leaves[p] += leaves[i]
            saving[p] += saving[i]
            least[p] = least[i] if least[p] is None else min(least[p], least[i])
    return [(least[i], depths[i], parent_conv if parents[i] < 0 else least[parents[i]], n[i], children[i], leaves[i], saving[i],
             hashlib.sha256(",".join(map(str, ends[i])).encode()).hexdigest()) for i in range(k)]


def _sweep(shard: pa.Table) -> pa.Table:
    """All nodes of a shard's containers, and for their tops the head (p1, p2) above."""
    c = {name: shard[name].to_pylist() for name in shard.column_names}
    containers: dict[tuple, dict] = {}
    for i in range(shard.num_rows):
        containers.setdefault((c["g1"][i], c["g2"][i]), {}).setdefault(c["conv"][i], []).append(i)
    out = []
    for convs in containers.values():
        members = []
        for conv, rows in convs.items():
            rows.sort(key=c["pos"].__getitem__)
            members.append(([(c["k1"][i], c["k2"][i]) for i in rows[:-1]], [c["words"][i] for i in rows], conv))
        members.sort(key=lambda m: (m[0], m[2]))
        i = rows[0]
        found = swept(members, c["pos"][i], c["parent_conv"][i])
        out.append((*found[0], c["p1"][i], c["p2"][i]))
        out.extend((*node, None, None) for node in found[1:])
    types = [pa.int64()] * 7 + [pa.string()] + [pa.int64()] * 2
    names = [f.split()[0] for f in OUT.split(", ")] + ["p1", "p2"]
    return pa.table([pa.array(list(v), t) for v, t in zip(zip(*out), types)], names=names)


def _on_head(a: str, b: str) -> Column:
    return (F.col(f"{a}.g1") == F.col(f"{b}.g1")) & (F.col(f"{a}.g2") == F.col(f"{b}.g2"))


def _burst(big: DataFrame) -> tuple[dict, DataFrame]:
    """One round: the nodes of the oversized containers' heads, and the rows of the containers under them.

    ``big``: (g1, g2, p1, p2, parent_conv, conv, pos, k1, k2, words); p1, p2: the head above, parent_conv: its node's least member."""
    by_pos = saved(big.groupBy(*HEAD, "pos").agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.max("words").alias("words"), F.max("p1").alias("p1"),
        F.max("p2").alias("p2"), F.max("parent_conv").alias("parent_conv"),
        F.coalesce((F.min("k1") != F.max("k1")) | (F.min("k2") != F.max("k2")), F.lit(False)).alias("parts")), TABLES)
    spans = cut(by_pos.groupBy(*HEAD).agg(F.min("pos").alias("top"), F.coalesce(
        F.min(F.when(F.col("parts"), F.col("pos"))), F.max("pos")).alias("end")))
    chain = saved(by_pos.alias("x").join(spans.alias("y"), _on_head("x", "y")).where("pos <= end").select("x.*", "top", "end"), TABLES)
    branch = cut(chain.where("pos = end").select(*HEAD, "end", "least"))
    placed = big.alias("x").join(branch.alias("y"), _on_head("x", "y")).select("x.*", "end", "least")
    ends = placed.where("pos <= end and k1 is null").select(*HEAD, "pos", "conv") \
        .repartition(*HEAD, "pos").sortWithinPartitions(*HEAD, "pos", "conv") \
        .mapInArrow(sha_of_ends(), "g1 long, g2 long, pos long, ends_sha256 string")
    next_head = placed.where("pos = end and k1 is not null").select(
        F.col("conv").alias("c"), F.xxhash64("g1", "k1", "k2").alias("n1"), F.xxhash64(F.lit(1), "g2", "k1", "k2").alias("n2"))
    behind = placed.where("pos > end").join(next_head, F.col("conv") == F.col("c")).select(
        F.col("n1").alias("g1"), F.col("n2").alias("g2"), F.col("g1").alias("p1"), F.col("g2").alias("p2"),
        F.col("least").alias("parent_conv"), "conv", "pos", "k1", "k2", "words")
    return {"chain": chain, "ends": saved(ends, TABLES)}, saved(behind, TABLES)


def _counted(level: dict, below: DataFrame) -> DataFrame:
    """The nodes of the heads of a round, (p1, p2) set at their tops.  ``below``: (p1, p2, children, leaves, saving) of
    the containers under each head."""
    chain = level["chain"].withColumn("own", (F.col("n") - 1) * F.coalesce("words", F.lit(0))) \
        .withColumn("block", F.floor(F.col("pos") / BLOCK))
    deeper = Window.partitionBy(*HEAD).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = chain.groupBy(*HEAD, "block").agg(F.sum("own").alias("sum")) \
        .select(*HEAD, "block", F.coalesce(F.sum("sum").over(deeper), F.lit(0)).alias("later"))
    inside = Window.partitionBy(*HEAD, "block").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    sums = chain.withColumn("sum", F.sum("own").over(inside)).join(blocks, [*HEAD, "block"])
    under = below.select(F.col("p1").alias("g1"), F.col("p2").alias("g2"), "children", "leaves", "saving")
    above = level["chain"].select(*HEAD, (F.col("pos") + 1).alias("pos"), F.col("least").alias("above"))
    top = F.col("pos") == F.col("top")
    return sums.join(under, HEAD, "left").join(above, [*HEAD, "pos"], "left").join(level["ends"], [*HEAD, "pos"], "left").select(
        F.col("least").alias("conv"), F.col("pos").alias("depth"), F.when(top, F.col("parent_conv")).otherwise(F.col("above")).alias("parent_conv"),
        F.col("n").alias("n_convs"), F.when(F.col("pos") < F.col("end"), 1).otherwise(F.coalesce("children", F.lit(0))).alias("n_children"),
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"), (F.col("sum") + F.col("later") + F.coalesce("saving", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), *(F.when(top, F.col(p)).alias(p) for p in ("p1", "p2")))


def _sums(tops: DataFrame) -> DataFrame:
    return tops.where("p1 is not null").groupBy("p1", "p2").agg(
        F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saving").alias("saving"))


def _tops(found: DataFrame) -> DataFrame:
    return found.select("p1", "p2", F.lit(1).alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saving"))


def nodes(turns: DataFrame, convs: DataFrame | None = None, burst_rows: int = BURST_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(conv, depth, parent_conv, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.  conv: the smallest
    member, whose turn number ``depth`` is the node's.

    ``turns``: (conv, pos, k1, k2, words), positions from 0 without gaps.  ``convs``: (conv) those that may have no turns."""
    null = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    rows = saved(positions(turns, convs).select(zero.alias("g1"), zero.alias("g2"), null.alias("p1"), null.alias("p2"),
                                                null.alias("parent_conv"), "conv", "pos", "k1", "k2", "words"), TABLES)
    levels, containers = [], []
    while True:
        oversized = cut(rows.groupBy(*HEAD).agg(F.count("*").alias("size")).where(F.col("size") > burst_rows))
        if oversized.isEmpty():
            containers.append(rows)
            break
        containers.append(rows.alias("x").join(oversized.alias("y"), _on_head("x", "y"), "left_anti"))
        level, rows = _burst(rows.alias("x").join(oversized.alias("y"), _on_head("x", "y"), "left_semi"))
        levels.append(level)
    left = containers[0]
    for more in containers[1:]:
        left = left.union(more)
    shards = max(1, -(-left.count() // shard_rows))
    found = saved(left.withColumn("shard", F.pmod(F.xxhash64(*HEAD), F.lit(shards))).groupBy("shard")
                  .applyInArrow(lambda t: _sweep(t.drop_columns(["shard"])), f"{OUT}, p1 long, p2 long"), TABLES)
    small = cut(_sums(_tops(found)))
    out, below = found, small
    for level in reversed(levels):
        heads = saved(_counted(level, below), TABLES)
        out = out.unionByName(heads)
        below = _sums(small.unionByName(_tops(heads)))
    return out.drop("p1", "p2")


def spliced(turns: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): each conversation c starts with the first h turns of conversation c - c % ``every``, all if it has fewer, none
    if there is none, and goes on behind its own first h; h = crc32(decimal c) % ``most``.  (% has the sign of c, as in SQL.)"""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(most)
    base = F.col("conv") - F.col("conv") % F.lit(every)
    sizes = cut(turns.groupBy("conv").agg(F.count("*").alias("n")))
    lenders = sizes.select(F.col("conv").alias("lender"), F.col("n").alias("room"))
    convs = cut(sizes.select("conv", h.alias("h"), base.alias("base")).join(lenders, F.col("base") == F.col("lender"), "left")
                .select("conv", "base", "h", F.least("h", F.coalesce("room", F.lit(0))).alias("got")))
    short = convs.where("got < h").select(F.col("conv").alias("c"), (F.col("got") - F.col("h")).alias("shift"))
    own = turns.where(F.col("pos") >= h).join(short, F.col("conv") == F.col("c"), "left") \
        .select("conv", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "k1", "k2", "words")
    first = turns.where((F.col("pos") < most - 1) & (F.col("conv") % every == 0)).withColumnRenamed("conv", "lender")
    lent = convs.where("got > 0").join(first, (F.col("base") == F.col("lender")) & (F.col("pos") < F.col("got"))) \
        .select("conv", "pos", "k1", "k2", "words")
    return own.union(lent), convs.select("conv")
