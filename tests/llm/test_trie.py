"""The prefix trie against a plain version that holds every prefix, with containers that burst and with none."""

import hashlib
import random
import re
import zlib

import pytest

from salespark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, conv int, pos int, k1 int, g1 int"  # names that clash


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], SCHEMA)


def conversations(rows):
    found = {}
    for c, turn, role, text in rows:
        if c is not None:
            found.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def spliced(convs, every=20, most=4):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = convs.get(int(c / every) * every, [])[:h] + turns[h:]  # % as in SQL: towards zero
    return out


def brute_force(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def words(node):
        return len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0

    out, total = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [total[k] for k in kids.get(node, [])]
        total[node] = (sum(b[0] for b in below) or 1, (len(members[node]) - 1) * words(node) + sum(b[1] for b in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if len(convs[c]) == len(node))))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids.get(node, [])),
                    *total[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed):
    r = random.Random(seed)
    rows = []
    for c in range(90):
        for t in range(r.randint(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "b c", "", "d  e\tf"])))
    for c in range(100, 125):                                     # copies of a long conversation, some cut short, some going on
        n = 40 - (c % 3) * 5
        rows += [(c, t, "user", f"long {t}") for t in range(n)] + ([(c, 99, "user", f"end {c}")] if c % 5 == 0 else [])
    rows += [(200, t, "user", f"only {t}") for t in range(300)]   # one long conversation
    rows += [(201, None, "user", "x"), (201, None, None, "y"), (201, 0, "user", None), (201, 0, "user", None)]
    rows += [(None, 0, "user", "x"), (-7, 1, "user", "a"), (7_000_000_001, 3, None, None), (999, 0, "é", "漢字 😀")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("splice, limits", [(True, (20, 60)), (False, (5, 1)), (False, (8_192, 65_536))])
def test_nodes_equal_brute_force(spark, splice, limits):
    rows = rows_of(3)
    turns, convs = trie.numbered(table(spark, rows).repartition(5)), None
    want = conversations(rows)
    if splice:
        turns, convs = trie.spliced(turns, 20, 4)
        want = spliced(want)
    got = trie.nodes(turns, convs, *limits).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(want)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "a") for c in range(21, 40)]           # no conversation 20: many lose their only turn
    turns, convs = trie.spliced(trie.numbered(table(spark, rows)), 20, 4)
    want = brute_force(spliced(conversations(rows)))
    assert sorted(map(tuple, trie.nodes(turns, convs).collect()), key=str) == want
    assert any(len(t) == 0 for t in spliced(conversations(rows)).values())
    assert sorted(map(tuple, trie.nodes(turns, convs, burst_rows=3).collect()), key=str) == want


def test_no_conversations(spark):
    for rows in ([], [(None, 0, "user", "x")]):
        turns, convs = trie.spliced(trie.numbered(table(spark, rows)), 20, 4)
        assert trie.nodes(turns, convs).count() == 0


def test_digest_streams_over_batches():
    import pyarrow as pa
    ends = [(1, 2, 0, c) for c in range(100)] + [(1, 2, 3, 5), (1, 3, 0, 9)]

    def batches(size):
        return [pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*ends[i:i + size])], ["g1", "g2", "pos", "conv"])
                for i in range(0, len(ends), size)]

    def run(size):
        return [tuple(r.values()) for b in trie.sha_of_ends()(iter(batches(size))) for r in b.to_pylist()]

    assert run(7) == run(1_000) == run(1)
    assert run(7)[0] == (1, 2, 0, hashlib.sha256(",".join(map(str, range(100))).encode()).hexdigest()) and len(run(7)) == 3
