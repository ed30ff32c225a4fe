import itertools
import random

import numpy as np
import public_tokenizers

from candleflow.llm import segment as S


def small(n=5, whole=False):
    rng = random.Random(7)
    names = ["a", "b", "▁", "ab", "ba", "aa", "▁a", "▁ab", "bb", "abb", "▁▁", "c"]
    scores = [float(-rng.randint(1, 12)) for _ in names]
    byte_ids = [100 + b for b in range(256)]
    raw = [p.replace("▁", " ").encode() for p in names] + [b""] * (100 - len(names)) + [bytes([b]) for b in range(256)]
    return S.Segmenter({p: (i, s) for i, (p, s) in enumerate(zip(names, scores))}, raw, byte_ids, n)


def brute(model, text):
    """All segmentations of the whole marked text, best scores first."""
    marked = "▁" + text.replace(" ", "▁")
    best, into, _ = model.lattice(marked)
    ways = {0: [(0.0, ())]}
    for j in range(1, len(marked) + 1):
        ways[j] = [(s + t - best[i], p + ids) for t, i, ids in into[j] for s, p in ways[i]]
    return sorted(ways[len(marked)], key=lambda x: -x[0])


def test_matches_all_segmentations():
    rng = random.Random(3)
    for n in (1, 3, 6):
        model = small(n)
        for _ in range(150):
            text = "".join(rng.choice("aabb c é") for _ in range(rng.randint(1, 11)))
            everything = brute(model, text)
            got = model.best(text)
            assert [s for s, _, _ in got] == [s for s, _ in everything[: len(got)]] and len(got) == min(n, len(everything))
            known = {ids: s for s, ids in everything}
            found = [tuple(np.frombuffer(ids, model.code).tolist()) for _, ids, _ in got]
            assert len(set(found)) == len(found) and all(known[f] == s for f, (s, _, _) in zip(found, got))
            assert all(right and model.decode(ids) == text.encode() for _, ids, right in got)


def test_remembered_words_do_not_change_the_result(monkeypatch):
    monkeypatch.setattr(S, "KEPT", 2)
    model, rng = small(4), random.Random(5)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(6)) for _ in range(60)]
    first = [model.best(t) for t in texts]
    assert first == [small(4).best(t) for t in texts]


def test_long_words_and_repeats_end():
    model = small(4)
    got = model.best("ab" * 3000)
    assert len(got) == 4 and all(right and model.decode(i) == b"ab" * 3000 for _, i, right in got)


def test_real_model_round_trip_and_edges(spark):
    texts = ["", None, "Hello world", "  two  spaces ", "é 日本 \n\tx", "a" * 5000, "Hello world", "zß\x00\x7f"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x", 1)], "doc_id long, text string, rank int")
    out = S.n_best(df, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert all(r.round_trip for r in out)
    rows = {(r.doc_id, r.rank): r for r in out}
    assert rows[0, 1].n_tokens == 0 and rows[1, 1].score == 0.0 and (0, 2) not in rows
    assert rows[2, 1].ids == rows[6, 1].ids and (None, 1) in rows
    for doc, group in itertools.groupby(sorted((r.doc_id, r.rank, r.score) for r in out if r.doc_id is not None), key=lambda x: x[0]):
        scores = [s for _, _, s in group]
        assert scores == sorted(scores, reverse=True)
    assert S.n_best(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_round_trip_is_that_of_the_whole_text():
    """What is kept per word says the same as decoding the whole text."""
    rng = random.Random(11)
    real = S.segmenter(public_tokenizers.path("piece_bpe_32k.model"), 4)
    for model in (small(4), real):
        for _ in range(200):
            text = "".join(rng.choice(["a", "b", "ab", " ", "▁", "é", "\n", ". ", "\x01", "日"]) for _ in range(rng.randint(0, 12)))
            assert all(right == (model.decode(ids) == text.encode()) for _, ids, right in model.best(text))


def test_second_best_is_that_of_the_search():
    rng = random.Random(12)
    model = small(3)
    for _ in range(300):
        word = "".join(rng.choice("aabbc é") for _ in range(rng.randint(1, 10)))
        loss, score, ids, _ = model.first(word)
        found = model.search(word.replace(" ", S.MARK))
        assert score == found[0][0] and ids == S.array(model.code, found[0][1]).tobytes()
        assert loss == (found[0][0] - found[1][0] if len(found) > 1 else float("inf"))


def test_ids_decode_to_the_texts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["", None, "Hello world", "  two  spaces ", "é 日本 \n\tx", "a" * 5000, "Hello world", "zß\x00\x7f"]
    found = S.n_best(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path)
    out = S.decoded(found.selectExpr("doc_id", "rank", "ids", "'x' as key", "1 as row"), path)
    assert out.columns == ["doc_id", "rank", "key", "row", "text"]
    rows = out.collect()
    assert len(rows) == found.count() and all(r.text == (texts[r.doc_id] or "") and r.key == "x" for r in rows)
    odd = spark.createDataFrame([(None,), (b"",)], "ids binary")
    assert [r.text for r in S.decoded(odd, path).collect()] == [None, ""]
    assert S.decoded(odd.limit(0), path).count() == 0
