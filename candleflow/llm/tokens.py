"""Fast exact encoding with a saved tokenizer.

A text is cut at single spaces between two non-space characters.  No token of
the tokenizers used here reaches across such a place, so encoding the pieces
and joining their ids equals encoding the text; pieces repeat, so most of them
come from a bounded table of pieces seen before.  The ids are those of the
library's plain call, added tokens included.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

# White space other than the space and the line feed, by either library's definition.
ODD_SPACE = re.compile(
    "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]"
)
# A place in front of a single space whose neighbours are plain letters or signs.
CUT = re.compile("(?<=[!-~\xa1-ɏ])(?= [!-~\xa1-ɏ])")
# Characters whose lower case and composed form depend on themselves alone.
PLAIN = re.compile("[^\x00-\u012f\u0131-\u024f]")
# A full stop or comma in front of a cut that doesn't simply follow a letter or digit.
JOINED = re.compile("[.,](?<=[^0-9A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f][.,])[ \x01]")
LONGEST_KEPT = 48

_ENCODERS: dict[tuple[str, int], "PieceEncoder"] = {}


def encoder(path: str, kept: int = 600_000) -> "PieceEncoder":
    """The encoder of a worker process, made once per tokenizer file."""
    if (path, kept) not in _ENCODERS:
        _ENCODERS[path, kept] = PieceEncoder(path, kept)
    return _ENCODERS[path, kept]


class PieceEncoder:
    """Texts to little-endian ids of ``width`` bytes each.

    ``kept`` bounds the remembered pieces: when so many are held they become
    the old generation, and the old one before is dropped.
    """

    def __init__(self, path: str, kept: int):
        # A task has one core; the library's threads cost a fifth more time on short pieces than they need alone.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        # A text that holds the string of an added token goes to the library whole, which gives the token's id.
        self.plain = Tokenizer.from_file(path)
        self.added = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        # In a piece such a string can only come from lower-casing and is ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.kept = kept
        # Some tokenizers drop white space and case; their pieces are then bare words.
        self.bare = self.ids(" A\nb ") == self.ids("a b")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def pieces(self, text: str) -> list[str]:
        if ODD_SPACE.search(text) or "\x01" in text:
            return CUT.split(text)
        if self.bare:
            if PLAIN.search(text):
                return CUT.split(text)
            text = text.lower().replace("\n", " ")
            # A stop or comma after a word is a token of its own.
            return (text if JOINED.search(text) else text.replace(". ", " . ").replace(", ", " , ")).split()
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] in " \n" or text[-1:] in " \n":
            return CUT.split(text)
        text = text.replace(" ", "\x01 ").replace("\n", "\x01\n\x01")
        return (text if JOINED.search(text) else text.replace(".\x01", "\x01.\x01").replace(",\x01", "\x01,\x01")).split("\x01")

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > self.kept:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        code = "H" if self.dtype.itemsize == 2 else "I"
        out: list[bytes] = []
        # Text by text while its pieces are fresh in the processor's cache, one look-up each: place, ids so far, gaps and their pieces.
        unfinished: list[tuple[int, list, list[int], list[str]]] = []
        for i, t in enumerate(texts):
            if any(a in t for a in self.added):
                out.append(array(code, self.plain.encode(t, add_special_tokens=False).ids).tobytes())
                continue
            pieces = self.pieces(t)
            found = list(map(young.get, pieces))
            try:
                out.append(b"".join(found))
            except TypeError:  # a piece is not known yet
                gaps = [k for k, ids in enumerate(found) if ids is None]
                unfinished.append((i, found, gaps, [pieces[k] for k in gaps]))
                out.append(b"")
        missing = []
        for p in set(chain.from_iterable(ps for *_, ps in unfinished)):
            if (ids := old.get(p)) is None:
                missing.append(p)
            else:
                young[p] = ids
        passing = [p for p in missing if len(p) > LONGEST_KEPT]
        for lo in range(0, len(missing), 4096):
            part = missing[lo : lo + 4096]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                young[p] = array(code, e.ids).tobytes()
        for i, found, gaps, ps in unfinished:
            for k, p in zip(gaps, ps, strict=True):
                found[k] = young[p]
            out[i] = b"".join(found)
        for p in passing:
            del young[p]
        return out
