"""Ranked search against plain Python, and the exactness of its tiles."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from candleflow.llm import lexical as L

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(L.WORD, low)


def brute(docs, items, k=L.TOP_K):
    counts = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    texts = {}
    for i, t in sorted(set(items), key=str):
        texts.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, wanted in texts.items():
        scored = []
        for i, c, n in counts:
            m = 100 - 75 + 75 * n * n_docs // total if total else 0
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in wanted.items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def found(spark, docs, items, **kw):
    out = L.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(map(tuple, out.collect()))


def random_texts(rng, n, words=40):
    pick = ["alpha", "Beta", "ÉTÉ", "été", "x1", "γ", "no-such", "A", "a.b", "1", "漢字", "q"]
    return [" ".join(rng.choice(pick) for _ in range(rng.randint(0, words))) for _ in range(n)]


def test_matches_brute_force_with_ties_nulls_and_repeats(spark):
    rng = random.Random(1)
    docs = list(enumerate(random_texts(rng, 150), -20)) + [(900 + i, "beta BETA copy") for i in range(30)]
    docs += [(None, "alpha q"), (None, None), (5, "alpha q"), (5, "alpha q"), (6, ""), (7, None), (8, " .-\x00\n")]
    items = [(i, t) for i, t in enumerate(random_texts(rng, 12, 9))] + [(50, None), (51, ""), (52, "copy beta beta"), (3, "alpha alpha"), (None, "q"), (60, "unseen"), (52, "copy beta beta")]
    rng.shuffle(docs)
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, 3)
    assert found(spark, docs, items, pass_terms=7) == brute(docs, items)  # several passes


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, "a")])])
def test_small_tables(spark, docs, items):
    assert found(spark, docs, items) == brute(docs, items)


def test_other_columns_are_ignored(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], DOCS).selectExpr("*", "1 as n", "'x' as held", "2 as item_id", "3 as score")
    items = spark.createDataFrame([(1, "a")], ITEMS).selectExpr("*", "'y' as term", "7 as doc_id")
    assert [(r.item_id, r.rank, r.doc_id) for r in L.search(docs, items).collect()] == [(1, 1, 1)]


def test_long_texts_are_cut_between_terms(monkeypatch):
    rng = random.Random(2)
    text = "\n".join(random_texts(rng, 40)) + " " + "z" * 300 + " end"
    want = [t.encode() for t in terms(text)]
    for stretch in (1, 2, 7, 64, 10**6):
        monkeypatch.setattr(L, "STRETCH", stretch)
        assert [t for part in L.terms(text.encode()) for t in part] == want
    assert list(L.terms(b"")) == []


def test_blocks_stay_exact_and_hold_every_weight():
    rng = random.Random(3)
    pairs = [(i, t, rng.randint(1, 50)) for i in range(7) for t in rng.sample(range(40), 15)]
    weights = np.array([rng.randint(0, 20000) for _ in range(40)])
    exact = 3_000 * L.IMPACT_LIMIT
    seen = Counter()
    for tile in L.item_tiles(pairs, weights, 7, per_tile=3, per_block=4, exact=exact):
        for columns, i, c, w in tile.blocks:
            assert len(columns) <= 4 and (w > 0).all()
            sums = np.bincount(i, w, len(tile.ids))
            assert (sums * L.IMPACT_LIMIT < exact).all()
            for a, b, x in zip(i, c, w):
                seen[int(tile.ids[a]), int(columns[b])] += int(x)
    assert seen == Counter({(i, t): n * int(weights[t]) for i, t, n in pairs if weights[t]})


def test_tile_top_k_keeps_ties_in_order():
    item = np.array([0, 0, 0, 0, 1, 1])
    score = np.array([5, 9, 5, 5, 2, 2])
    doc_id = np.array([4, 8, 0, 3, 1, 0])
    known = np.array([True, True, False, True, True, True])
    got = [x.tolist() for x in L.cut((item, score, doc_id, known), 3)]
    assert got[:3] == [[0, 0, 0, 1, 1], [9, 5, 5, 2, 2], [8, 3, 4, 0, 1]]
