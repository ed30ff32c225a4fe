import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candleflow.llm.tokens import PieceEncoder

PARTS = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "'", " '", "3", "!", ".", ",", ". ", ", ", "|", "\xa0", "ß", "\u0301", "日", "İ", "Σ", "\x1c", "\x01", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_the_whole_text(name):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(8000)]
    texts += [" ".join(rng.choice(["one,", "Two.", "thr'ee", "4.5", "six"]) for _ in range(30)) for _ in range(300)]
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    enc = PieceEncoder(public_tokenizers.path(name), kept=50)  # few kept: both generations are used
    got = [ids for lo in range(0, len(texts), 64) for ids in enc(texts[lo : lo + 64])]
    want = whole.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, enc.dtype).tolist() for g in got] == [w.ids for w in want]


def test_known_pieces_are_looked_up_once():
    """A text of known pieces takes one look-up a piece, and a new piece is encoded once a call."""
    enc = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), kept=1000)

    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return super().get(key)

        def __contains__(self, key):
            Counted.asked += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    texts = ["one two three one", "two one"]
    first = enc(texts)
    enc.young = Counted(enc.young)
    assert enc(texts) == first and Counted.asked == sum(len(enc.pieces(t)) for t in texts)
    assert enc(["one seven", "seven two"]) == [enc(["one seven"])[0], enc(["seven two"])[0]]
