import heapq

import numpy as np
import pytest

from candleflow.llm import huffman as H


def plain_huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        cost += s
        heapq.heappush(heap, s)
    return cost


def test_lengths_are_optimal_without_a_binding_limit():
    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = rng.integers(0, 50, rng.integers(2, 40))
        if np.count_nonzero(counts) < 2:
            continue
        lengths = H.code_lengths(counts, 30)
        assert int((lengths * counts).sum()) == plain_huffman_cost(counts)


def test_lengths_respect_the_limit_and_fill_the_code():
    counts = np.array([2**k for k in range(20)])
    lengths = H.code_lengths(counts, 6)
    assert lengths.max() <= 6
    assert sum(2.0 ** -int(n) for n in lengths) == 1.0
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(5, int), 2)


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.02, n), 900).astype(np.int64)
    lengths = H.code_lengths(np.bincount(ids, minlength=3), 12) if n else np.array([0, 0, 1])
    data = H.encode_block(ids, lengths, H.canonical(lengths))
    assert H.decode_block(data, *H.decode_table(lengths)).tolist() == ids.tolist()


def test_single_symbol_and_damage():
    ids = np.full(300, 2)
    lengths = H.code_lengths(np.bincount(ids))
    data = H.encode_block(ids, lengths, H.canonical(lengths))
    assert H.decode_block(data, *H.decode_table(lengths)).tolist() == ids.tolist()
    with pytest.raises(ValueError):
        H.decode_block(data[:-1] + b"\x55", *H.decode_table(lengths))
