"""op2, op6 and op9 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest

from salespark.llm import decontam, queries, quotes, secret_scan

from . import fixtures as X

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_contamination(docs, items):
    ws = lambda t: WORD.findall((t or "").translate(LOWER))
    wins = {}
    for i, t in items:
        w = ws(t)
        if i is None or not w:
            continue
        n = min(13, len(w))
        for p in range(len(w) - n + 1):
            wins.setdefault(tuple(w[p:p + n]), set()).add(i)
    lengths = {len(w) for w in wins}
    out = []
    for i, t in docs:
        w, hit, found = ws(t), set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in wins:
                    found |= wins[tuple(w[p:p + n])]
                    hit |= set(range(p, p + n))
        out.append((i, len(w), len(hit), tuple(sorted(map(str, found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEM = X.prose(70, 40)
ITEMS = [(1, ITEM), (1, ITEM), (10, ITEM + " tail"), (2, X.prose(71, 13)), (3, X.prose(72, 4)), (4, "zu"), (5, ""), (6, None),
         (None, X.prose(73, 20)), (7, "É x, Y!"), (8, "again " * 30)]


def planted():
    w = ITEM.split()
    return [
        *((i, t) for i, t, *_ in X.ODD if i != 13),
        (100, X.prose(80, 300) + " " + ITEM), (101, ITEM.upper()), (102, " ".join(w[3:16])), (103, " ".join(w[3:15])),
        (104, ", ".join(w[:20]) + "!"), (105, " ".join([*w[:6], "gap", *w[6:]])), (106, X.prose(72, 4) + " and " + X.prose(72, 4)),
        (107, "before zu after"), (108, "again " * 100), (109, "É X\ny"), (110, "é x y"), (111, X.prose(71, 13) + " " + ITEM),
        (111, X.prose(71, 13) + " " + ITEM), (112, X.prose(73, 20)), (113, X.prose(81, 2000) + " " + X.prose(71, 13)),
    ]


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_contamination_equals_brute_force(spark, broadcast_rows):
    docs = planted()
    d = X.docs(spark, docs)
    items = spark.createDataFrame([(i, t, 3, 4) for i, t in ITEMS], "item_id long, text string, doc int, sid int")
    got = decontam.contamination(d, items, broadcast_rows=broadcast_rows).collect()
    want = brute_contamination(docs, ITEMS)
    assert sorted(((r.doc, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got), key=str) == want
    assert any(w[4] for w in want) and any(w[2] and not w[4] for w in want)
    left = decontam.clean(d, items, broadcast_rows=broadcast_rows)
    assert left.columns == d.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(w[0] for w in want if not w[4])


def test_no_documents_or_no_items(spark):
    d = X.docs(spark, planted())
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontam.contamination(d, none).collect()
    assert len(got) == len(planted()) and all(r.n_hit == 0 and not r.contaminated and r["items"] == [] for r in got)
    some = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontam.contamination(d.where("false"), some).count() == 0


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ALLOW = [re.compile(a) for a in secret_scan.ALLOW]


def brute_spans(t):
    t = t or ""
    base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    more = []
    for no, (kind, alphabet, n, bits) in enumerate(secret_scan.CLASSES, 3):
        for m in re.finditer("[" + re.escape(alphabet) + "]{%d,}" % n, t):
            s = m[0]
            if not re.search("[0-9]", s) or not re.search("[A-Za-z]", s) or any(a.search(s) for a in ALLOW):
                continue
            spans = []
            for i in range(len(s) - n + 1):
                h = math.log2(n) - sum(c * math.log2(c) for c in Counter(s[i:i + n]).values()) / n
                if h >= bits - 1e-10:
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + n
                    else:
                        spans.append([i, i + n])
            more += [(m.start() + a, no, m.start() + b, kind) for a, b in spans
                     if not any(x[0] <= m.start() + a and x[2] >= m.start() + b for x in base)]
    return sorted(base), sorted(base + more)


def secrets():
    r = random.Random(7)
    b64 = lambda n: "".join(r.choice(secret_scan.CLASSES[1][1]) for _ in range(n))
    hx = lambda n, a="0123456789abcdef": "".join(r.choice(a) for _ in range(n))
    return [None, "", "password=short", "Token : 'abcdefghijkl'", "token: secret=\"abcdefghijklm\"", "api_key==abcdefghijklmnop",
            "APIKEY = x password=token=abcdefghijklmnopq", "AKIA" + "A1" * 7, "AKIA" + "A1" * 6, "AKIAAKIA" + "Z" * 9,
            "é😀 " + hx(16) + " " + hx(15) + "g" + hx(40), "x" + b64(60) + " y", b64(24), b64(23), "A" * 80 + "1", b64(40) + "A" * 60 + b64(30),
            "3f2504e0-4f89-11d3-9a0c-0305e82c3301", "some_snake_case_identifier_name_12", "your_" + b64(30), "2024-01-01-00-00-00-123456-000",
            hx(32, "0123456789ABCDEF"), "0123456789" * 3, "password = " + b64(30), " ".join(b64(r.randint(20, 70)) for _ in range(20)),
            *(x[1] for x in X.ODD)]


def test_spans_equal_brute_force(spark):
    texts = secrets()
    d = X.docs(spark, list(enumerate(texts)))
    got = {r.id: r for r in secret_scan.scan(d).select(
        "id", secret_scan.written(secret_scan.F.col("base")).alias("base"), secret_scan.written(secret_scan.F.col("spans")).alias("spans"),
        *(secret_scan.F.size(k).alias(k) for k in ("assign", "access", "hex"))).collect()}
    text = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    kinds = Counter()
    for i, t in enumerate(texts):
        base, spans = brute_spans(t)
        assert (got[i].base, got[i].spans) == (text(base), text(spans)), t
        assert [got[i].assign, got[i].access, got[i].hex] == [sum(s[1] == k for s in base) for k in range(3)]
        kinds.update(s[3] for s in spans)
    assert len(kinds) == 5 and secret_scan.scan(d.where("false")).count() == 0


def test_many_matches_in_one_text(spark):
    """Beyond one block of places: runs, assignments and entropy spans against brute force; the cost grows with the text."""
    import time
    r = random.Random(8)
    run = lambda n, a: "".join(r.choice(a) for _ in range(n))
    mixed = " ".join(r.choice([run(20, "0123456789abcdef"), run(40, secret_scan.CLASSES[1][1]), "token=" + run(14, "abcXYZ012"), "word"])
                     for _ in range(600))
    hexes = [" ".join(run(17, "0123456789abcdef") for _ in range(n)) for n in (5_000, 20_000)]
    took = []
    for t in (mixed, *hexes):
        began = time.monotonic()
        row = secret_scan.scan(X.docs(spark, [(1, t)])).select(secret_scan.written(secret_scan.F.col("spans")).alias("spans")).first()
        took.append(time.monotonic() - began)
        assert row.spans == ",".join(f"{k}:{a}:{b}" for a, _, b, k in brute_spans(t)[1])
    assert took[2] < 8 * max(took[1], 1), took  # four times the text


def test_op9_digest(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(duckdb.execute(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    for r in queries.op9_secrets(spark, sf).collect():
        base, spans = brute_spans(texts[r.doc_id])
        want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


THREAD = [
    (1, 0, "Shall we meet on Monday?\nI have the figures.\n\nBest, A"),
    (1, 1, "> Shall we meet on Monday?\nYes, at ten."),
    (1, 2, "On Tuesday B wrote:\n>> Shall we meet on Monday?\n> Yes, at ten.\nFine.\n>  I HAVE   the figures.\nSend them."),
    (1, 3, "> Shall we meet on Monday? I have\n> the figures.\nWrapped anew."),
    (1, 4, "> never said by anyone\nA stray quotation."),
    (1, 5, "> Fine.\n> Send them.\nDone."),
    (1, 6, "No quotation, 3 > 2."),
    (2, 0, "> Fine.\nAnother conversation."),
    (2, 1, None), (None, 0, "> x"), (2, None, "y"), (3, 0, "Thanks"), (3, 1, "> Thanks\nThanks"), (3, 2, "> Thanks\nThanks"), (3, 2, "> Thanks\nThanks"),
]


def test_quotations_are_linked(spark):
    d = spark.createDataFrame([(c, t, "user", x, 0, 0) for c, t, x in THREAD],
                              "conv_id long, turn long, role string, text string, root int, level int")
    got = quotes.conversations(d).collect()
    assert len(got) == len(THREAD)
    by = {(r.conv, r.turn): r for r in got}
    parents = {k: r.parent for k, r in by.items()}
    assert parents == {(1, 0): None, (1, 1): 0, (1, 2): 0, (1, 3): 0, (1, 4): None, (1, 5): 2, (1, 6): None, (2, 0): None, (2, 1): None,
                       (None, 0): None, (2, None): None, (3, 0): None, (3, 1): 0, (3, 2): 0}
    assert {k[1]: (r.root, r.depth) for k, r in by.items() if k[0] == 1} == {
        0: (0, 0), 1: (0, 1), 2: (0, 1), 3: (0, 1), 4: (4, 0), 5: (0, 2), 6: (6, 0)}
    assert by[1, 2].text == "Fine.\nSend them." and by[1, 2].n_quotes == 3 and by[1, 2].unlinked == []
    assert by[1, 4].unlinked == ["never said by anyone"] and by[2, 0].unlinked == ["Fine."]
    assert by[1, 0].text == THREAD[0][2] and by[1, 6].text == "No quotation, 3 > 2." and by[2, 1].text == ""
    order = [(r.conv, r.turn) for r in got if r.conv == 1]
    assert order == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 5), (1, 4), (1, 6)]
    assert quotes.conversations(d.where("false")).count() == 0


def test_long_chains_of_answers(spark):
    d = spark.createDataFrame([(1, i, "u", (f"> line number {i - 1}\n" if i else "") + f"line number {i}") for i in range(70)],
                              "conv_id long, turn long, role string, text string")
    assert [(r.turn, r.root, r.depth) for r in quotes.conversations(d).collect()] == [(i, 0, i) for i in range(70)]


def test_op2_keeps_every_message(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op2_quotes(spark, sf).select("conv_id", "turn", "text").collect()
    want = duckdb.execute(f"select conv_id, turn, trim(text) from '{sf}/conversations.parquet'").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
