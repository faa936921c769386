"""op3 and op8 against brute force; the pipeline and the entry module."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salespark.llm import bitslice, packing

from . import fixtures as X


@pytest.mark.parametrize("dims,rows,span", [(3, 200, 4), (8, 70, 40), (1, 5, 1), (0, 4, 1), (5, 64, 1000)])
def test_bit_slices_add_up(dims, rows, span):
    rng = np.random.default_rng(dims)
    v = rng.integers(-span, span, (rows, dims))
    block = bitslice.Slices(v)
    for q in rng.integers(-span, span, (20, dims)):
        total, constant = block.scores(q)
        bits = np.zeros((0, rows), np.int64) if not len(total) else np.unpackbits(total.view(np.uint8).reshape(len(total), -1), axis=1, bitorder="little")[:, :rows].astype(np.int64)
        score = (bits << np.arange(len(total))[:, None]).sum(axis=0) + constant
        assert (score == v @ q).all()
        own = np.array([0])
        at, got = block.top(q, 3, own)
        order = sorted((-(v[i] @ q), i) for i in range(rows) if i)[:3]
        assert sorted(zip(at.tolist(), got)) == sorted((i, -s) for s, i in order)


def test_top_k_of_odd_rows_equals_brute_force(spark):
    r = random.Random(4)
    vecs = [(i, [r.choice([-.5, -.2, 0., .1, .3]) for _ in range(6)]) for i in range(130)]
    vecs += [(130, None), (131, [None] * 6), (132, [math.nan] * 6), (133, [math.inf] + [0.] * 5), (None, [1.] * 6), (134, []), (135, [1.] * 2),
             (140, [2.] * 2), (20, [9.] * 6), (5, vecs[5][1]), (5, vecs[5][1]), (136, [2.**62] * 6), (137, [2.**20] * 6)]
    d = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in vecs], "vec_id long, embedding array<double>, id int, block int, dims int")
    got = bitslice.top_k(d, F.col("id") % 20 == 0, k=7, block_rows=40, query_rows=3).collect()
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v in vecs
            if i is not None and i != 136 and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q in sorted({i for i, _ in fine if i % 20 == 0}):
        s = sorted((-sum(a * b for a, b in zip(u, v)), j) for i, u in fine if i == q for j, v in fine if j != q and len(u) == len(v))
        want += [(q, n, j, -x) for n, (x, j) in enumerate(s[:7], 1)]
    assert any(w[2] == 137 for w in want)
    assert sorted(map(tuple, got)) == sorted(want) and any(w[0] == 140 for w in want)
    assert bitslice.top_k(d.where("false"), F.col("id") % 20 == 0).count() == 0


def test_repeated_rows_agree_with_the_sql(spark, tmp_path):
    from salespark.llm import queries as Q
    from tools.oracle_check import compare
    import duckdb
    r = random.Random(9)
    rows = [(i % 45, [r.choice([-.5, 0., .25]) for _ in range(4)]) for i in range(90)] + [(3, [.5] * 4)] * 30
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert compare(spark, con, "op3", Q.op3_bitslice, Q.OP3_SQL, str(tmp_path), verbose=False)


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    r = random.Random(seed)
    lengths = sorted(r.sample(range(1, 60), 9))
    counts = [r.randint(1, 20) for _ in lengths]
    for k in (1, 2, 3, 9, 12):
        ends = packing.boundaries(np.array(lengths), np.array(counts), k)
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for n in range(min(k, 9))
                   for c in itertools.combinations(lengths[:-1], n))
        assert len(ends) <= k and ends[-1] == lengths[-1] and padding(lengths, counts, ends) == best


def test_batches_hold_every_token_once(spark):
    d = X.docs(spark, [*X.ODD, *((1000 + i, X.prose(i, i % 90)) for i in range(400))])
    got = packing.pack(d, max_length=64, buckets=4, budget=256, shard_rows=10).collect()
    want = sorted(((r[0], len((r[1] or "").encode().split()) + 1) for r in X.rows(
        [*X.ODD, *((1000 + i, X.prose(i, i % 90)) for i in range(400))])), key=str)
    per = {}
    for r in got:
        per[r.id] = per.get(r.id, 0) + r.length
        assert 0 < r.length <= r.bucket and r.start == 64 * r.chunk
    total = {}
    for i, n in want:
        total[i] = total.get(i, 0) + n
    assert per == total
    batches = {}
    for r in got:
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    for b in {k[0] for k in batches}:
        own = sorted(k[1] for k in batches if k[0] == b)
        room = max(1, 256 // b)
        assert own == list(range(len(own)))
        assert all(sorted(batches[b, n]) == list(range(room if n < own[-1] else len(batches[b, n]))) for n in own)
        assert room * b <= 256 or room == 1
    hist = {}
    for r in got:
        hist[r.length] = hist.get(r.length, 0) + 1
    lengths = sorted(hist)
    ends = sorted({r.bucket for r in got})
    best = min(padding(lengths, [hist[n] for n in lengths], [*c, lengths[-1]]) for c in itertools.combinations(lengths[:-1], 3))
    assert len(ends) == 4 and sum(r.bucket - r.length for r in got) == best


def test_repeated_rows_are_dealt_over_shards(spark):
    d = X.docs(spark, [(1, "a b c")]).crossJoin(spark.range(500).select())
    got = packing.pack(d, max_length=64, buckets=2, budget=16, shard_rows=10)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert any("xxhash64" in line and "row#" in line for line in plan.splitlines())
    slots = sorted((r.batch, r.slot) for r in got.collect())
    assert slots == [(n // 4, n % 4) for n in range(500)]


def test_nothing_to_pack(spark):
    assert packing.pack(X.docs(spark, X.ODD).where("false")).count() == 0


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "pack"]
    spark.createDataFrame([(1, X.prose(70, 40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(200 + i, X.prose(200 + i, 60), "aa") for i in range(20)]
    texts = [*X.ODD, *clean, (300, X.prose(70, 40) + " " + X.prose(300, 30), "aa")]
    for rows in (texts, []):
        docs = X.docs(spark, rows)
        for n, (name, stage) in enumerate(P.STAGES):
            path = str(tmp_path / f"{len(rows)}-{n}")
            new = stage(spark, docs, str(tmp_path))
            if n < 4:
                assert new.columns == docs.columns
            new.write.parquet(path)
            docs = spark.read.parquet(path)
        ids = {r.doc_id for r in docs.collect()}
        assert {i for i, *_ in clean} <= ids if rows else not ids
        assert 300 not in ids and 3 not in ids


def test_pipeline_filters_what_it_should(spark):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    got = P.run(spark, sf)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    left = {r.doc_id for r in got.collect()}
    assert left < set(docs)
    assert len({r.text for r in docs.values()}) - 40 < len(left)


def test_entry_lists_the_queries():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
    assert set(E.oracle_sql()) <= names
