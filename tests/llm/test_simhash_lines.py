"""op4 and op7 against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from salespark.llm import graph, linededup, simhash

from . import fixtures as X


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w)] if len(w) <= k else [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)]
    ones = [0] * 64
    for x in s:
        h = xxhash.xxh64_intdigest(x, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(s))


def union(n, pairs):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in pairs:
        p[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for t in (None, "", "a", "a b", "A b\x0bc", "a  b\tc d", X.BASE, "é à ü ß"):
        assert simhash.fingerprint(None if t is None else t.encode()) == brute_fp(t), t
    assert simhash.fingerprint("É a".encode()) != simhash.fingerprint("é a".encode())  # A-Z only


def test_embedding_is_a_lower_bound(spark):
    r = random.Random(1)
    pairs = []
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for _ in range(r.randint(0, 6)):
            b ^= 1 << r.randrange(64)
        pairs.append((a - (a >> 63 << 64), b - (b >> 63 << 64)))
    d = spark.createDataFrame(pairs, "a long, b long")
    rows = d.select(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("h"), F.bit_count(
        simhash.unary_counts(F.col("a")).bitwiseXOR(simhash.unary_counts(F.col("b")))).alias("m")).collect()
    assert all(x.m <= x.h for x in rows) and any(0 < x.m for x in rows)


def test_links_equal_brute_force(spark):
    r = random.Random(5)
    fps = {0, 2**64 - 1}
    for _ in range(120):
        a = r.getrandbits(64)
        fps.add(a)
        for _ in range(4):
            b = a
            for _ in range(r.randint(1, 5)):
                b ^= 1 << r.randrange(64)
            fps.add(b)
    signed = sorted(f - (f >> 63 << 64) for f in fps)
    g = spark.createDataFrame([(f, f) for f in signed], "fp long, node long")
    got = {(min(x.a, x.b), max(x.a, x.b)) for x in simhash.links(g).collect()}
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert got == want and want


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200), (None, 5)]
    got = dict(graph.components(spark.createDataFrame(edges, "a int, b int")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a int, b int")).count() == 0


@pytest.fixture(scope="module")
def odd(spark):
    near = X.BASE.split()
    near[60] = "changed"
    return X.ODD + [(20, " ".join(near)), (21, X.prose(50, 20_000) + " end")]


def test_near_duplicates_of_odd_rows(spark, odd):
    got = simhash.near_duplicates(X.docs(spark, odd)).collect()
    assert len(got) == len(odd)
    fps = [brute_fp(t) for _, t, *_ in odd]
    comp = union(len(odd), [(i, j) for i in range(len(odd)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    least = {}
    for (i, *_), c in zip(odd, comp):
        least[c] = min([x for x in (least.get(c), i) if x is not None], default=None)
    want = sorted(((i, f, least[c]) for (i, *_), f, c in zip(odd, fps, comp)), key=str)
    assert sorted(((x.id, x.fp % 2**64, x.component) for x in got), key=str) == want


def test_one_of_each_group_stays(spark, odd):
    d = X.docs(spark, odd)
    left = simhash.without_copies(d)
    assert left.columns == d.columns
    got = [r.doc_id for r in left.collect()]
    fps = [brute_fp(t) for _, t, *_ in odd]
    comp = union(len(odd), [(i, j) for i in range(len(odd)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    best = {}
    for (i, *_), c in zip(odd, comp):
        best[c] = min(best.get(c, 10**9), 10**8 if i is None else i)
    assert sorted(got, key=str) == sorted((None if b == 10**8 else b for b in best.values()), key=str)
    assert simhash.without_copies(d.where("false")).count() == 0


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def norm(line):
    return [w for w in line.lower().replace("\t", " ").replace("\r", " ").split(" ") if w]


def brute_lines(docs):
    """({(doc, line): first occurrence} of all lines but empty ones, number of links), by edit similarity alone."""
    occ = [(i, n, tuple(norm(x))) for i, t in docs if t is not None for n, x in enumerate(t.split("\n"))]
    occ = [o for o in occ if o[2]]
    lines = sorted({o[2] for o in occ})
    texts = [" ".join(x) for x in lines]
    links = []
    for i in range(len(lines)):
        for j in range(i):
            a, b = sorted((texts[i], texts[j]), key=len)
            allowed = int(len(b) * 0.2 + 1e-9)
            if len(b) - len(a) <= allowed and sum((Counter(b) - Counter(a)).values()) <= allowed and lev(a, b) <= allowed:
                links.append((i, j))
    comp = dict(zip(lines, union(len(lines), links)))
    first = {}
    for i, n, w in occ:
        first[comp[w]] = min(first.get(comp[w], (10**9, 0)), (i, n))
    return {(i, n): first[comp[w]] for i, n, w in occ}, len(links)


def fuzzy_docs():
    r = random.Random(3)
    base = [X.prose(s, 40) for s in range(20, 26)]
    out = []
    for i in range(30):
        lines = []
        for b in r.sample(base, 3):
            w = b.split()
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                w[r.randrange(len(w))] += r.choice("stn")
            lines.append(" ".join(w))
        out.append((i, "\n".join([*lines, "Short line.", "", X.prose(1000 + i, 9)])))
    return out


def test_line_classes_equal_brute_force(spark):
    docs = fuzzy_docs()
    want, links = brute_lines(docs)
    got = linededup.classes(X.docs(spark, docs)).collect()
    assert {(r.doc, r.line_no): (r["class"].doc, r["class"].line_no) for r in got} == want and len(got) == len(want)
    assert links > 10
    assert all(r.kept == ((r.doc, r.line_no) == want[r.doc, r.line_no]) for r in got)


def test_counters_of_either_width_agree(spark):
    d = X.docs(spark, [*fuzzy_docs(), (99, "a b c d e f")])
    rows = linededup.documents(d, "doc_id", "text")
    narrow = {(r.doc, r.line_no): r.fp for r in linededup.fingerprints(rows).collect()}
    many = " ".join(f"w{i}" for i in range(17_000))
    wide = {(r.doc, r.line_no): r.fp for r in linededup.fingerprints(linededup.documents(
        d.union(X.docs(spark, [(200, many + "\n" + many.replace("w5 ", "v5 "))])), "doc_id", "text")).collect()}
    assert {k: v for k, v in wide.items() if k[0] != 200} == narrow
    h = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in many.split()], dtype=">u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0)
    assert wide[200, 0] % 2**64 == int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big") and (200, 1) in wide


def test_lines_taken_out_of_the_texts(spark):
    docs = fuzzy_docs()
    want, _ = brute_lines(docs)
    d = X.docs(spark, docs)
    left = linededup.without_copies(d)
    assert left.columns == d.columns
    for r in left.collect():
        lines = dict(docs)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for n, x in enumerate(lines) if want.get((r.doc_id, n), (r.doc_id, n)) == (r.doc_id, n))


def test_lines_of_odd_rows(spark):
    d = X.docs(spark, X.ODD)
    got = linededup.without_copies(d).collect()
    assert len(got) == len(X.ODD)
    by = {r.doc_id: r.text for r in got if r.doc_id is not None}
    assert by[0] == "" and by[1] == "" and by[2] == ""  # the row without id sorts first and is near to them all
    assert by[3] is None and by[4] == "" and by[8] == X.prose(2, 3) and by[13] == X.prose(50, 20_000)
    assert linededup.without_copies(d.where("false")).count() == 0


@pytest.mark.parametrize("a,b,same", [("abcde" * 2, "abcde" * 2, True), ("a" * 10, "a" * 8 + "bb", True),
                                      ("a" * 10, "a" * 7 + "bbb", False), ("a" * 8, "a" * 10, True), ("a" * 7, "a" * 10, False)])
def test_similarity_at_the_threshold(spark, a, b, same):
    assert spark.range(1).select(linededup.similar(F.array(F.lit(a)), F.array(F.lit(b)))).first()[0] is same


def test_similarity_of_word_arrays_is_that_of_their_texts(spark):
    r = random.Random(8)
    pairs = []
    for _ in range(400):
        a = [r.choice(["a", "bb", "abc", "ba", "cabab"]) for _ in range(r.randint(1, 14))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            k = r.randrange(3)
            if k == 0 and len(b) > 1:
                del b[r.randrange(len(b))]
            elif k == 1:
                b.insert(r.randint(0, len(b)), r.choice(["a", "bb", "abc"]))
            else:
                b[r.randrange(len(b))] += r.choice("abc")
        pairs.append((a, b))
    got = [x.s for x in spark.createDataFrame(pairs, "a array<string>, b array<string>").select(
        linededup.similar(F.col("a"), F.col("b")).alias("s")).collect()]
    want = []
    for a, b in pairs:
        a, b = " ".join(a), " ".join(b)
        want.append(lev(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9))
    assert got == want and 50 < sum(want) < 350


def test_repeated_rows_do_not_fill_a_counter(spark):
    line = " ".join(f"w{i}" for i in range(20))
    d = X.docs(spark, [(1, line), (2, line)])
    d = d.where("doc_id = 1").crossJoin(spark.range(2_600).select()).union(d.where("doc_id = 2"))
    got = linededup.classes(d).collect()
    assert sorted((r.doc, r.line_no, r["class"].doc, r.kept) for r in got) == [(1, 0, 1, True), (2, 0, 1, False)]
    fps = linededup.fingerprints(linededup.documents(d, "doc_id", "text")).select("k1", "k2", "fp").distinct()
    assert fps.count() == 1


def test_lines_of_few_words_take_part_in_query_and_stage(spark, tmp_path):
    import corpus_pipeline as P
    from salespark.llm import queries as Q
    zh = "\u9019\u662f\u4e00\u500b\u6c92\u6709\u7a7a\u683c\u7684\u6bb5\u843d" * 3
    X.docs(spark, [(i, f"All rights\n\n{zh}\n{X.prose(60 + i, 9)}\n \t\nEnd.") for i in range(3)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.kept) for r in Q.op7_lines(spark, str(tmp_path)).collect()}
    assert got == {(i, n): (i, n, True) if n == 3 else (0, n, i == 0) for i in range(3) for n in (0, 2, 3, 5)}
    left = P.line_dedup(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in left if r.doc_id} == {i: f"\n{X.prose(60 + i, 9)}\n \t" for i in (1, 2)}


def test_small_edits_are_found_in_lines_of_any_length(spark):
    r = random.Random(11)
    base = [X.prose(300 + i, n) for i, n in enumerate([2, 3, 6, 6, 6, 8, 12, 12, 30, 30])]
    base.append("".join(chr(0x4e00 + r.randrange(3_000)) for _ in range(60)))
    docs = [(2 * i + k, line) for i, b in enumerate(base) for k, line in enumerate(
        [b, (lambda at: b[:at] + "q" + b[at:])(r.randrange(len(b) // 3, len(b)))])]
    texts = [" ".join(norm(x)) for _, x in docs]
    links = [(i, j) for i in range(len(texts)) for j in range(i)
             if lev(texts[i], texts[j]) <= int(max(len(texts[i]), len(texts[j])) * 0.2 + 1e-9)]
    comp = union(len(texts), links)
    want = {i: min(j for j in range(len(docs)) if comp[j] == comp[i]) for i in range(len(docs))}
    got = {x.doc: x["class"].doc for x in linededup.classes(X.docs(spark, docs)).collect()}
    assert got == want and len(links) >= len(base)


def test_counted_characters_bound_the_edit_distance(spark):
    r = random.Random(21)
    pairs = [("".join(r.choice("aeo. tz\u6f22") for _ in range(r.randint(0, 30))), "".join(r.choice("aeo. tz\u6f22") for _ in range(r.randint(0, 30))))
             for _ in range(200)] + [("e" * 300, "e" * 200), ("eeee", "tttt")]
    d = spark.createDataFrame(pairs, "x string, y string")
    named = d.select("x", "y", *(c.alias(f"{p}{n}") for p, t in (("a_", "x"), ("b_", "y")) for n, c in zip(linededup.COUNTS, linededup.counts(F.col(t)))))
    got = named.select("x", "y", linededup.fewest_edits("a_", "b_").alias("n")).collect()
    assert all(g.n <= lev(g.x, g.y) for g in got) and got[-1].n == 4 and sum(g.n > 0 for g in got) > 150


def crowd():
    """Lines of one key: several groups of near copies, and lines on their own."""
    r = random.Random(31)
    common = X.prose(900, 30).split()
    docs = []
    for g in range(6):
        own = [w if r.random() < 0.5 else w + "q" * 12 for w in common]
        for k in range(12 if g < 4 else 1):
            w = list(own)
            w[r.randrange(len(w))] += "x"
            docs.append((len(docs), " ".join(w)))
    return docs


def test_parts_of_a_crowded_key_meet_without_all_pairs(spark):
    rows = [(1, i, 0x0101 * (1 + i % 3), 40, i % 5) for i in range(500)] + [(2, 7, 1, 40, 2), (2, 8, 1, 40, 2)]
    near = spark.createDataFrame([(*x, None, None, None) for x in rows], "key long, line long, fp long, size int, part long, c0 long, c1 long, c2 long")
    got = linededup.between_parts(near).collect()
    part = {line: p for _, line, _, _, p in rows}
    assert got and len(got) <= 2 * 8 * 3 * 5 and all(part[x.a] != part[x.b] and x.a < x.b for x in got)


def test_classes_of_a_crowded_key_equal_brute_force(spark, monkeypatch):
    seen = []
    real = linededup.between_parts
    monkeypatch.setattr(linededup, "between_parts", lambda near: seen.append(near.count()) or real(near))
    docs = crowd()
    want, links = brute_lines(docs)
    got = linededup.classes(X.docs(spark, docs)).collect()
    assert {(r.doc, r.line_no): (r["class"].doc, r["class"].line_no) for r in got} == want and links > 100 and seen


def test_components_of_few_edges_need_no_shuffle(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    plans = []
    real = graph.cut
    try:
        graph.cut = lambda df, rows=None: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, rows)
        out = graph._stars(graph._stars(edges, True, 40), False, 40)
    finally:
        graph.cut = real
    assert len(plans) == 2 and not any("Exchange" in p for p in plans) and out.count() > 0


def test_components_let_go_of_each_round(spark, monkeypatch):
    called = []
    monkeypatch.setattr(graph, "let_go", lambda s: called.append(s))
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.component for r in graph.components(edges).collect()} == {0} and called


def test_size_of_components_does_not_grow_with_the_rounds(spark, monkeypatch):
    """Spark's estimate, a product for each join, had four times the digits after each round: it alone filled the driver's memory."""
    monkeypatch.setattr(graph, "FILE_ROWS", 10)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    part = graph.components(edges)
    assert part.groupBy("component").count().collect() == [(0, 61)]
    assert part._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 200
