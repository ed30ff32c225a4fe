import os

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candleflow.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_best_fit_is_valid_and_tight():
    rng = np.random.default_rng(1)
    for capacity in (10, 64, 2048):
        lengths = rng.integers(1, capacity + 1, 500)
        at, offset, fills = P.best_fit(lengths, capacity)
        for b, fill in enumerate(fills):
            inside = sorted(zip(offset[at == b].tolist(), lengths[at == b].tolist()))
            assert sum(n for _, n in inside) == fill <= capacity
            assert all(o == sum(n for _, n in inside[:k]) for k, (o, _) in enumerate(inside))
        assert len(fills) <= 11 / 9 * np.ceil(lengths.sum() / capacity) + 40


def test_best_fit_takes_the_fullest_bin():
    at, offset, fills = P.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert fills == [10, 10] and at.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]


def test_cuts():
    assert P.cut(1, 8) == [(0, 1)] and P.cut(8, 8) == [(0, 8)] and P.cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


@pytest.mark.parametrize("group", [5, 50_000])
def test_whole_operator(spark, group):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 900, rng.integers(0, 60))), 5, "b") for i in range(150)]
    rows += [(200, None, 1, "x"), (201, "", 1, "x"), (None, "a b", 1, "x"), rows[4], (202, "z y " * 2000, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, bin int, fill string").repartition(7)
    packed = P.pack(df, PATH, capacity=64, end_id=0, free=1, buffer=300, group=group)
    out = packed.sequences().collect()
    enc = Tokenizer.from_file(PATH)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    want = sorted(((i is None, i or 0), tuple(enc.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, *_ in rows)
    by_doc, by_sequence = {}, {}
    for r in out:
        ids = tuple(np.frombuffer(r.ids, f"<u{packed.width}").tolist())
        assert len(ids) == r.length <= 64
        by_doc.setdefault(r.doc_id, []).append((r.start, r.piece, ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert all(o == sum(n for _, n in places[:k]) for k, (o, _) in enumerate(places)) and sum(n for _, n in places) <= 64
    single = [(i, t) for i, t in want if i != (False, 4)]
    for (no_id, i), ids in single:
        pieces = sorted(by_doc[None if no_id else i])
        assert tuple(x for _, _, p in pieces for x in p) == ids and [k for _, k, _ in pieces] == list(range(len(pieces)))
        assert all(len(p) == 64 for _, _, p in pieces[1:])
    assert len(by_doc[4]) == 2 * len([1 for _ in P.cut(len(dict(want)[False, 4]), 64)])
    total = sum(len(ids) for _, ids in want)
    assert len(by_sequence) <= 1.1 * total / 64 + 3


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).sequences().count() == 0
