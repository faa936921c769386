"""The kd-tree search: its parts exactly, its answers by their recall against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salespark.llm import kdsearch as S

SCHEMA = "vec_id long, embedding array<double>, id int, v int, cell int, ids int, bound int"  # names that clash


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 1, 1, 1, 1) for i, v in rows], SCHEMA)


def clustered(seed, n, dims, groups=30, spread=0.3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((groups, dims))
    return centres[r.integers(0, groups, n)] + spread * r.standard_normal((n, dims))


def found(df, k=20, **how):
    out = {}
    for r in sorted(S.nearest(df, F.col("id") % 20 == 0, k=k, **how).collect()):
        out.setdefault(r.query_id, []).append(r)
        assert r.rank == len(out[r.query_id])
    return {q: [(r.vec_id, r.score) for r in rs] for q, rs in out.items()}


def brute_force(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            scores = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


@pytest.mark.parametrize("lengths", ["equal", "unequal"])
def test_recall_over_many_blocks(spark, lengths):
    x = clustered(1, 1_500, 24)
    if lengths == "equal":
        x /= np.linalg.norm(x, axis=1)[:, None]
    rows = list(enumerate(x))
    got, want = found(table(spark, rows), block_rows=128), brute_force(rows, 20)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    exact = {(q, i): s for q, v in rows if q % 20 == 0 for i, s in enumerate(x @ v)}
    assert all(len(g) == 20 and all(math.isclose(s, exact[q, i], rel_tol=1e-12, abs_tol=1e-12) for i, s in g) for q, g in got.items())


def test_one_vector_in_a_third_of_all_rows(spark):
    x = clustered(2, 400, 16)
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[::3] = x[0]
    rows = list(enumerate(x))
    got, want = found(table(spark, rows), block_rows=128), brute_force(rows, 20)
    assert recall(got, want) >= 0.9
    for q in got:
        if q % 3 == 0:  # copies of the query by their ids
            assert [i for i, _ in got[q]] == [i for i in range(0, 400, 3) if i != q][:20]


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1, 0]), (1, [1, 0]), (1, [1, 0]), (2, [0, 2]), (3, None), (4, []), (5, [0, 0]), (6, [nan, 1]), (7, [inf, 1]), (8, [None, 1]),
            (None, [3, 3]), (9, [1, 2, 3]), (20, [0, 1]), (40, [1, 1, 1]), (60, [5]), (80, [-1, 0]), (80, [-1, 0]), (100, [0, -1e-9])]
    got = found(table(spark, rows), k=20)
    assert [i for i, _ in got[0]] == [1, 1, 2, 20, 100, 80, 80]  # a repeated row is a candidate twice
    assert [i for i, _ in got[20]] == [2, 0, 1, 1, 80, 80, 100]
    assert got[40] == [(9, 6.0)] and [i for i, _ in got[80]] == [2, 20, 100, 0, 1, 1]
    assert set(got) == {0, 20, 40, 80, 100}                      # 60 has no other of its length
    assert [i for i, _ in found(table(spark, rows), k=3)[0]] == [1, 1, 2]


def test_large_and_small_values(spark):
    for scale in (1e150, 1e-150, 1e200):
        rows = [(i, [scale * (i + 1), scale]) for i in range(30)]
        got = found(table(spark, rows), k=5)
        assert set(got) == {0, 20} and (scale == 1e200 or [i for i, _ in got[0]] == [29, 28, 27, 26, 25])


def test_no_vectors(spark):
    assert not found(table(spark, [])) and not found(table(spark, [(0, None)]))
    with pytest.raises(ValueError):
        S.nearest(table(spark, []), F.lit(True), m=7)


def test_stopping_test_is_the_chi_square_quantile():
    assert abs(S.quantile(0.95, 12) - 21.026) < 1e-3 and abs(S.quantile(0.9, 8) - 13.362) < 1e-3
    r = np.random.default_rng(0)
    x = S.projected(r.standard_normal((2_000, 30)), 100.0, 12, S.SEED)
    y = S.projected_queries(r.standard_normal((2_000, 30)), 12, S.SEED)
    assert np.isfinite(x).all() and np.isfinite(y).all()


def test_tree_holds_every_point_and_survives_storage():
    r = np.random.default_rng(5)
    x = r.standard_normal((777, 10))
    ids = [np.array([i, i + 1_000]) for i in range(777)]
    t = S.Tree.from_bytes(S.Tree.build(x, ids, float(S.norms(x).max()), 12, 1).to_bytes())
    assert sorted(t.ids.tolist()) == sorted([*range(777), *range(1_000, 1_777)]) and sorted(t.rows[t.rows >= 0].tolist()) == list(range(777))
    # with no stopping test the search is exact
    q = r.standard_normal((5, 10))
    for i, (scores, got) in enumerate(t.search(q, np.full(5, -1), np.full(5, -np.inf), 10, 1e9, 12, 1)):
        s = np.concatenate([x @ q[i]] * 2)
        want = np.lexsort((np.concatenate([np.arange(777), np.arange(1_000, 1_777)]), -s))[:10]
        assert got.tolist() == [int(w) if w < 777 else int(w) + 223 for w in want] and np.allclose(scores, s[want])
