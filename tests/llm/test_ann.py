import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from candleflow.llm import ann as A

DDL = "vec_id long, embedding array<float>, rank int, score string"


def brute(rows, k=5, every=5):
    good = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows
            if i is not None and v and len(v) == 16 and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    out = {}
    for i in good:
        if i % every == 0:
            s = sorted((-float(good[i] @ w / np.linalg.norm(good[i]) / np.linalg.norm(w)), j) for j, w in good.items() if j != i)[:k]
            out[i] = [(j, -x) for x, j in s]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], DDL)


def check(spark, rows, least=1.0):
    got = {}
    for r in A.nearest(table(spark, rows), F.col("vec_id") % 5 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = brute(rows)
    assert got.keys() == {i for i, w in want.items() if w}
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in got)
    assert hits >= least * sum(len(want[i]) for i in got)
    for i in got:
        scores = [s for _, s in got[i]]
        assert scores == sorted(scores, reverse=True) and len(got[i]) == len(want[i])
        exact = dict(want[i])
        assert all(abs(s - exact[j]) < 1e-12 for j, s in got[i] if j in exact)


def test_matches_brute_force_with_bad_rows_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=16))]) for i in range(120)]
    rows += [(200 + i, rows[5][1]) for i in range(8)] + [rows[5], rows[10]]
    rows += [(300, None), (305, [0.0] * 16), (310, [float("nan")] * 16), (315, [None] + [1.0] * 15), (320, [1.0] * 3), (None, rows[0][1]), (325, [float("inf")] * 16)]
    check(spark, rows, least=0.97)


def test_recall_on_clusters(spark):
    rng = np.random.default_rng(2)
    mid = rng.normal(size=(10, 16))
    rows = [(i, [float(c) for c in np.float32(mid[i % 10] + 0.4 * rng.normal(size=16))]) for i in range(1500)]
    check(spark, rows, least=0.9)


@pytest.mark.parametrize("rows", [[], [(5, [1.0] * 16)], [(5, [1.0] * 16), (6, [1.0] * 15 + [2.0])], [(6, [1.0] * 16)]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_scan_abandons_but_keeps_the_near():
    rng = np.random.default_rng(3)
    x = A.unit(rng.normal(size=(400, 64)))
    y = A.unit(x[:5] + 0.02 * rng.normal(size=(5, 64)))
    turn = A.rotation(64)
    q, r, d = A.scan(x @ turn, y @ turn, np.full(5, 0.2))
    assert {(i, i) for i in range(5)} <= set(zip(q.tolist(), r.tolist()))
    assert len(q) < 20 and np.all(d <= 0.2 + 1e-9)
