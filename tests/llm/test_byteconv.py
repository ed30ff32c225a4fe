import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from candleflow.llm import byteconv as B


def make(rng, good):
    text = " ".join("".join(rng.choice("aeioubcdst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 90)))
    return text if good else text.replace(" ", "*** ")


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(32, 126, n).tolist()) for n in (0, 3, 9, 150, 700, 2000)]
    labels = np.array([1, 0, 1, 0, 1, 0], np.float32)
    net = B.Network.start(2)
    for p in net.parameters():
        p += 0.01
    for name in ("wide", "b1", "w2", "b2", "w3", "b3"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    loss, grads = B.gradients(net, texts, labels)
    rng = np.random.default_rng(3)
    for p, g in zip(net.parameters(), grads, strict=True):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p.shape)
            old = p[at]
            p[at] = old + 1e-5
            up = B.gradients(net, texts, labels)[0]
            p[at] = old - 1e-5
            down = B.gradients(net, texts, labels)[0]
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 2e-3 * max(1, abs(g[at]))


def test_score_does_not_depend_on_the_batch():
    net, rng = B.Network.start(4), np.random.default_rng(5)
    texts = [bytes(rng.integers(0, 256, n).tolist()) for n in (0, 1, 4, 5, 8, 131, 132, 133, 260, 5000)]
    together = B.logits(net, texts)
    assert np.allclose(together, [B.logits(net, [t])[0] for t in texts], atol=1e-5)


def test_the_whole_text_counts():
    net = B.Network.start(4)
    plain = b"a plain text. " * 3000
    assert B.logits(net, [plain])[0] != B.logits(net, [plain + b"###!!" * 40 + plain])[0]


def test_learns_and_holds_out(spark):
    rng = random.Random(6)
    docs = [(i, make(rng, i % 3 != 0), "s") for i in range(600)] + [(700, None, "s"), (701, "", "s"), (None, "x y", "s"), (702, "long " * 200_000, "s")]
    labels = [(i, int(i % 3 != 0), 0) for i in range(600)] + [(5, None, 0), (None, 1, 0), (6, 1, 0), (900, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    l = spark.createDataFrame(labels, "doc_id long, quality int, text int")  # noqa: E741
    net = B.train(d, l)
    out = {r.doc_id: r for r in B.score(d, net).collect()}
    assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out.values())
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [i for i in range(600) if out[i].held_out]
    assert np.mean([out[i].predicted == (i % 3 != 0) for i in held]) > 0.95
    kept = B.passing(d, net)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.predicted}


def test_held_out_labels_are_never_used(spark):
    """Wrong labels on held-out rows leave the network as it is."""
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, make(rng, i % 2 == 0)) for i in range(80)], "doc_id long, text string")
    right = [(i, int(i % 2 == 0)) for i in range(80)]
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in right]
    a, b = (B.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (right, wrong))
    assert all(np.array_equal(x, y) for x, y in zip(a.parameters(), b.parameters()))


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (1, 1)]])
def test_without_both_classes(spark, labels):
    d = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    net = B.train(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert isinstance(net, float) and B.score(d, net).count() == 2
    assert B.score(d.limit(0), net).count() == 0


def test_texts_are_scored_a_few_at_a_time(monkeypatch):
    """A worker holds the arrays of about SCORE_BYTES of text, not of a whole batch, and scores every row."""
    texts = ["x" * 5000 + str(k) for k in range(200)] + [None, "y" * 300_000]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    seen, real = [], B.logits
    monkeypatch.setattr(B, "logits", lambda net, part: seen.append(part) or real(net, part))
    net = B.Network.start()
    scored = pa.Table.from_batches(B._scored(iter([batch]), net)).to_pydict()
    assert scored["doc_id"] == list(range(len(texts)))
    assert all(sum(map(len, part)) <= (1 << 17) + 10_000 or len(part) <= 2 for part in seen) and len(seen) >= 8
    one = np.array([B._probabilities(net, [t])[0] for t in texts])
    assert np.allclose(scored["score"], one, atol=1e-6)
    seen.clear()
    passed = pa.Table.from_batches(B._passed(iter([batch]), net, -1.0), schema=batch.schema)
    assert passed.num_rows == len(texts) and len(seen) >= 8
