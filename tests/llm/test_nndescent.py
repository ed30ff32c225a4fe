import math

import numpy as np
import pytest

from candleflow.llm import nndescent as N


def brute(rows, threshold=0.9):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows
            if i is not None and v and len(v) == 16 and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    ids = sorted(good)
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = {i: 0 for i, _ in rows}
    for a in ids:
        for b in ids:
            if a < b and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), i == find(i)) for i, _ in rows if i is not None}


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, n_links int, root int")
    out = N.link_vectors(df).collect()
    assert len(out) == len(rows)
    want = brute(rows)
    for r in out:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == want[r.vec_id]


@pytest.fixture
def rows():
    rng = np.random.default_rng(3)
    mid = rng.normal(size=(60, 16))
    out = [(i, [float(c) for c in np.float32(rng.normal(size=16))]) for i in range(150)]
    for g in range(60):
        for j in range(int(rng.integers(1, 8))):
            out.append((1000 + 100 * g + j, [float(c) for c in np.float32(mid[g] + 0.12 * rng.normal(size=16))]))
    return out


def test_matches_brute_force(spark, rows):
    copies = [(50000 + i, rows[170][1]) for i in range(40)]
    bad = [(300, None), (305, [0.0] * 16), (310, [float("nan")] * 16), (315, [None] + [1.0] * 15), (320, [1.0] * 3), (None, rows[0][1]), (325, [float("inf")] * 16)]
    scaled = [(60000, [2 * c for c in rows[3][1]])]
    check(spark, rows + copies + bad + scaled)


def test_clusters_beyond_a_block(spark, rows, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = np.random.default_rng(4)
    mid = rng.normal(size=16)
    crowd = [(9000 + i, [float(c) for c in np.float32(mid + 0.25 * rng.normal(size=16))]) for i in range(90)]
    check(spark, rows[:100] + crowd)


def test_sparse_links_among_many_buckets(spark, monkeypatch):
    """Isolated pairs just above the threshold, many bits a bucket."""
    monkeypatch.setattr(N, "BUCKET", 4)
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    pairs = np.concatenate([a, 0.91 * a + np.sqrt(1 - 0.91**2) * b])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(pairs)]
    out = N.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sum(r.n_links for r in out) >= 0.97 * 800


NEAR = 0.9995


def _on_a_sphere(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(1500, 3)) @ rng.normal(size=(3, 16))
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(points)]
    unit = np.float32(points).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    true = int((unit @ unit.T >= NEAR).sum()) - len(rows)
    return true, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_rounds_find_what_the_start_misses(spark, monkeypatch):
    """Three trees dealt into small blocks hold few of the links; the rounds
    find the others, without a look at the audit."""
    monkeypatch.setattr(N, "BLOCK", 16)
    true, df = _on_a_sphere(spark)
    found = {settled: sum(r.n_links for r in N.link_vectors(df, NEAR, trees=3, settled=settled, recall=0).collect()) for settled in (1.0, 0.01)}
    assert true > 500 and found[1.0] < 0.5 * true and found[0.01] >= 0.98 * true


def test_a_low_recall_adds_trees_or_ends_the_job(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    true, df = _on_a_sphere(spark)
    # One tree parts the vectors, so rounds alone find nothing between its blocks.
    assert sum(r.n_links for r in N.link_vectors(df, NEAR, trees=1).collect()) >= 0.97 * true
    monkeypatch.setattr(N, "MOST_TREES", 1)
    with pytest.raises(RuntimeError, match="recall"):
        N.link_vectors(df, NEAR, trees=1)


def test_audit_grows_until_it_holds_sparse_links(spark):
    rng = np.random.default_rng(6)
    lone = rng.normal(size=(1500, 64))
    lone[-10:] = lone[:10] + 0.1 * rng.normal(size=(10, 64))
    crowd = rng.normal(size=64) + 0.1 * rng.normal(size=(700, 64))
    nodes = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(np.concatenate([lone, crowd]))], "id long, v array<float>, copies long")
    truth = N._audited(nodes, 2200, 64, 0.9, 8)
    assert (truth["near"] == 1).sum() >= 8
    found = spark.createDataFrame([(i, 699) for i in range(1500, 2200)], "id long, links long")
    assert N._recall(truth, found) == 0
    assert N._recall(truth[truth['near'] == 0], found) is None


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0] * 16)], [(1, [1.0] * 16), (1, [1.0] * 16), (2, [1.0] * 16)]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in N.link_vectors(df).collect())
    want = {(): [], (1,): [(1, 0, 1, True)], (1, 1, 2): [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]}
    assert out == want[tuple(i for i, _ in rows)]
