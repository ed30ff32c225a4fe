from collections import Counter

import numpy as np
import pytest

from candleflow.llm import minhash as M


def bag(text, size=5):
    w = (text or "").lower().split()
    if not w:
        return Counter()
    if len(w) < size:
        return Counter([tuple(w)])
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def jaccard(a, b):
    lo, hi = sum((a & b).values()), sum((a | b).values())
    return lo / hi if hi else 0.0


def random_texts(rng, n, vocabulary=30, longest=60):
    return [" ".join(f"w{k}" for k in rng.integers(0, vocabulary, rng.integers(0, longest))) for _ in range(n)]


def test_shingles_and_overlap_match_counters():
    rng = np.random.default_rng(2)
    texts = [*random_texts(rng, 80, 3, 40), "", None, "  ", "One", "one\ttwo\n three", "ÄÖ ü ä", "a b c d e", "x " * 500]
    t, h, c = M.shingles(texts)
    for k, text in enumerate(texts):
        assert sorted(c[t == k].tolist()) == sorted(bag(text).values())
    right = texts[::-1]
    got = M.overlap([x or "" for x in texts], [x or "" for x in right])
    assert np.allclose(got, [jaccard(bag(a), bag(b)) for a, b in zip(texts, right)])


def test_long_texts_are_hashed_in_stretches(monkeypatch):
    rng = np.random.default_rng(3)
    texts = random_texts(rng, 20, 50, 300)
    whole = M.shingles(texts)
    monkeypatch.setattr(M, "STEP", 64)
    assert all(np.array_equal(x, y) for x, y in zip(whole, M.shingles(texts)))


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(4)
    m, n = 4096, 6
    bags = [{int(k): int(w) for k, w in zip(rng.choice(40, 25, False), rng.integers(1, 40, 25))} for _ in range(n)]
    text = np.concatenate([np.full(len(b), k) for k, b in enumerate(bags)])
    keys = M.mix64(np.array([k for b in bags for k in b], np.uint64) + np.uint64(9))
    sig = M.signatures(text, keys, np.array([w for b in bags for w in b.values()]), n, m)
    for i in range(n):
        for j in range(i):
            a, b = Counter(bags[i]), Counter(bags[j])
            want = jaccard(a, b)
            assert abs((sig[i] == sig[j]).mean() - want) < 5 * np.sqrt(want * (1 - want) / m) + 0.005


def test_signature_does_not_depend_on_the_batch():
    rng = np.random.default_rng(5)
    texts = random_texts(rng, 40, 12, 80)
    t, h, c = M.shingles(texts)
    together = M.signatures(t, h, c, len(texts), 64)
    for k in (0, 7, 39):
        t1, h1, c1 = M.shingles([texts[k]])
        assert np.array_equal(M.signatures(t1, h1, c1, 1, 64)[0], together[k])


def brute(rows, threshold=0.8):
    ids = [i for i, t in rows if i is not None]
    bags = {i: bag(t) for i, t in rows if i is not None}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in bags:
        for b in bags:
            if a < b and bags[a] and bags[b] and jaccard(bags[a], bags[b]) >= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_groups_match_brute_force(spark):
    rng = np.random.default_rng(6)
    rows, texts = [], []
    for _ in range(12):
        words = [f"w{k}" for k in rng.integers(0, 5000, rng.integers(40, 200))]
        for _ in range(rng.integers(1, 9)):
            copy = list(words)
            for p in rng.integers(0, len(copy), rng.integers(0, 2)):
                copy[p] = f"n{rng.integers(0, 10**6)}"
            texts.append(" ".join(copy))
    rows = list(zip(rng.permutation(len(texts)).tolist(), texts))
    rows += [(900, ""), (901, None), (902, "one two"), (903, "one  TWO"), (904, "  "), (None, texts[0]), rows[0], rows[0]]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    out = M.near_duplicates(df).collect()
    assert len(out) == len(rows)
    want = brute(rows)
    for r in out:
        if r.doc_id is None:
            assert r.group_id is None and r.kept
        else:
            assert r.group_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])


def test_a_chain_in_one_bucket_is_joined(spark):
    """Members that all miss the smallest one are still linked to each other."""
    words = [f"w{k}" for k in range(300)]

    def changed(*at):
        return " ".join("z" + w if k in at else w for k, w in enumerate(words))

    rows = [(0, changed(10, 40)), (1, changed(100, 130, 160)), (2, changed(100, 130, 160, 190)), (3, changed(200, 230, 260, 290))]
    out = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=40, rows=2).collect()
    assert {r.doc_id: r.group_id for r in out} == brute(rows)


def test_bytes_that_agree_by_chance_are_no_earlier_meeting():
    """Only equal band keys say that a pair met in an earlier band."""
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(words), " ".join(words[:299])]

    def linked(bands):
        part = M.pd.DataFrame({"band": 1, "bucket": 7, "id": [1, 2], "root": [1, 2], "n": [296, 295], "block": 0, "lo": 0, "hi": 0,
                               "sig": [bytes(144)] * 2, "bands": [np.array(b) for b in bands], "text": texts})
        return M._linked(part, 0.8, 5).to_numpy().tolist()

    assert linked([[5, 7], [6, 7]]) == [[1, 2]]
    assert linked([[5, 7], [5, 7]]) == []


def test_blocks_of_a_bucket_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 2)
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join("z" + w if k in at else w for k, w in enumerate(words))) for i in range(12) for at in [set(rng.integers(0, 300, 5).tolist())]]
    out = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=40, rows=2).collect()
    assert {r.doc_id: r.group_id for r in out} == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, None)]])
def test_nothing_to_compare(spark, rows):
    out = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows) and all(r.kept for r in out)
