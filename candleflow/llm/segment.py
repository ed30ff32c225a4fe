"""N-best segmentation with a saved SentencePiece model, and decoding.

The pieces that match a text make a lattice; a segmentation's score is the
sum of its pieces' scores.  A forward Viterbi pass gives the best score of
every prefix, which is the exact remaining cost for an A-star search that runs
backward from the end: segmentations come out best first.  No piece holds a
space mark after another character, so the lattice is a chain of words: words
are searched one by one, the results remembered, and the few alternatives
that matter are merged over the text.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from bisect import insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.llm.common import importable, load, slices

MARK = "▁"
BEST = 4
#: Below the lowest score of an ordinary piece, for a character that no piece holds alone.
PENALTY = 10.0
#: Scores of this and less mark pieces that are kept out of ordinary segmentations.
NEVER = -1e8
KEPT, LONGEST_KEPT = 500_000, 64
WORD = re.compile("(?<=[^ ])(?= )")

_MODELS: dict[tuple[str, int], "Segmenter"] = {}


def segmenter(path: str, n: int) -> "Segmenter":
    """The segmenter of a worker process, made once per model file."""
    if (path, n) not in _MODELS:
        _MODELS[path, n] = Segmenter.load(path, n)
    return _MODELS[path, n]


@dataclass
class Segmenter:
    """``pieces``: id and score of each ordinary piece; ``raw``: the bytes that
    each id stands for; ``byte_ids``: the id of each byte."""

    pieces: dict[str, tuple[int, float]]
    raw: list[bytes]
    byte_ids: list[int]
    n: int = BEST

    def __post_init__(self) -> None:
        # Every prefix of a piece, with the piece's score and id if it is one itself.
        self.steps: dict[str, tuple | None] = dict.fromkeys(p[:k] for p in self.pieces for k in range(1, len(p)))
        self.steps |= {p: (score, (i,)) for p, (i, score) in self.pieces.items()}
        # The same as a tree: (children by character, score and ids of the piece that ends here).
        self.tree: dict[str, list] = {}
        for p, (i, score) in self.pieces.items():
            level = self.tree
            for c in p:
                node = level.setdefault(c, [{}, None])
                level = node[0]
            node[1] = (score, (i,))
        self.longest = max(map(len, self.pieces), default=1)
        self.fallback = min((s for _, s in self.pieces.values() if s > NEVER), default=0.0) - PENALTY
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece has a space mark after another character")
        # No piece spans a place whose two characters stand together in none.
        self.line_feeds = not any("\n" in p for p in self.pieces)
        before = {p[k - 1] for p in self.pieces for k in range(1, len(p)) if p[k] in ".,"}
        self.joined = re.compile(f"[.,](?<=[{re.escape(''.join(sorted(before | {' ', chr(10), chr(1)})))}][.,])[ \x01]")
        self.code = "H" if max(len(self.raw), max(self.byte_ids) + 1) <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.known: dict[str, list] = {}

    @classmethod
    def load(cls, path: str, n: int = BEST) -> "Segmenter":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, raw, byte_ids = {}, [], [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                pieces[piece] = (i, sp.get_score(i))
                raw.append(piece.replace(MARK, " ").encode())
        return cls(pieces, raw, byte_ids, n)

    def lattice(self, word: str) -> tuple[list[float], list[list[tuple[float, int, tuple[int, ...]]]], list]:
        """The forward pass: for each place of ``word`` the best score up to
        it, the edges (score up to its end, start, ids) that lead there, and
        the best of them."""
        get, n = self.steps.get, len(word)
        best, into, lead = [float("-inf")] * (n + 1), [[] for _ in range(n + 1)], [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            for j in range(i + 1, n + 1):
                found = get(word[i:j], 0)
                if found:
                    v = here + found[0]
                    edge = (v, i, found[1])
                    into[j].append(edge)
                    if v > best[j]:
                        best[j], lead[j] = v, edge
                elif found == 0:
                    break
            if not get(word[i]):
                edge = (here + self.fallback, i, tuple(self.byte_ids[b] for b in word[i].encode()))
                into[i + 1].append(edge)
                if edge[0] > best[i + 1]:
                    best[i + 1], lead[i + 1] = edge[0], edge
        return best, into, lead

    def first(self, word: str) -> tuple[float, float, bytes, bool]:
        """(loss of the second best segmentation, best score, ids of the best,
        whether these decode to the word): a forward pass that keeps the two
        best scores of every place."""
        marked = word.replace(" ", MARK)
        n, tree, reach, never = len(marked), self.tree, self.longest, float("-inf")
        best, second, lead = [never] * (n + 1), [never] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here, level, j = best[i], tree, i
            for c in marked[i : i + reach]:
                node = level.get(c)
                if node is None:
                    break
                j += 1
                level, piece = node
                if piece:
                    v = here + piece[0]
                    if v > best[j]:
                        w = second[i] + piece[0]
                        second[j] = w if w > best[j] else best[j]
                        best[j], lead[j] = v, (i, piece[1])
                    elif v > second[j]:
                        second[j] = v
            node = tree.get(marked[i])
            if node is None or not node[1]:
                v, w, j = here + self.fallback, second[i] + self.fallback, i + 1
                if v > best[j]:
                    second[j] = max(w, best[j])
                    best[j], lead[j] = v, (i, tuple(self.byte_ids[b] for b in marked[i].encode()))
                elif v > second[j]:
                    second[j] = v
        at, parts = n, []
        while at:
            at, ids = lead[at]
            parts.append(ids)
        ids = [i for p in reversed(parts) for i in p]
        return best[n] - second[n], best[n], array(self.code, ids).tobytes(), self.spelt(ids) == word.encode()

    def spelt(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))

    def search(self, word: str) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of ``word``: score and ids, best
        first, ties in a fixed order.

        A state is a place and the pieces behind it; its value, the score
        behind plus the best score in front, is reached by some segmentation.
        So a state is followed along its best edge to the start at once, and
        of the other edges only those are kept whose value is among the ``n``
        best values seen."""
        best, into, lead = self.lattice(word)
        n = len(word)
        out, count, values = [], 0, [-best[n]]
        heap = [(-best[n], 0, n, 0.0, None)]
        while heap and len(out) < self.n:
            f, _, at, behind, path = heapq.heappop(heap)
            while at:
                first = lead[at]
                for e in into[at]:
                    if e is not first:
                        v = -(e[0] + behind)
                        if len(values) < self.n or v < values[-1]:
                            insort(values, v)
                            del values[self.n :]
                            count += 1
                            heapq.heappush(heap, (v, count, e[1], e[0] - best[e[1]] + behind, (e[2], path)))
                at, behind, path = first[1], behind + first[0] - best[first[1]], (first[2], path)
            ids: list[int] = []
            while path:
                ids += path[0]
                path = path[1]
            out.append((-f, tuple(ids)))
        return out

    def words(self, text: str) -> list[str]:
        """The parts of ``text`` that no piece spans, spaces in front of each;
        the model puts one space before every text."""
        if not text:
            return []
        text = " " + text
        if "  " in text or text[-1] == " " or "\x01" in text:
            return WORD.split(text)
        text = text.replace(" ", "\x01 ")[1:]
        if self.line_feeds:
            text = text.replace("\n", "\x01\n\x01")
        if not self.joined.search(text):
            text = text.replace(".\x01", "\x01.\x01").replace(",\x01", "\x01,\x01")
        return text.split("\x01")

    def others(self, word: str) -> list[tuple[float, bytes, bool]]:
        """(loss, ids, whether they decode to the word) of the segmentations
        after the best."""
        if word not in self.known:
            if len(self.known) > KEPT // 8:
                self.known.clear()
            found = self.search(word.replace(" ", MARK))
            self.known[word] = [(found[0][0] - s, array(self.code, ids).tobytes(), self.spelt(ids) == word.encode()) for s, ids in found[1:]]
        return self.known[word]

    def best(self, text: str) -> list[tuple[float, bytes, bool]]:
        """The ``n`` best segmentations of a text: score, ids, ``width`` bytes
        each in native order, and whether they decode to the text.  A word's
        ids are decoded once, when its segmentation is found: the parts spell
        the text if each spells its word."""
        words = self.words(text)
        if len(self.young) > KEPT:
            self.old, self.young = self.young, {}
        young = self.young
        passing = []
        for w in set(words).difference(young):
            young[w] = self.old.get(w) or self.first(w)
            if len(w) > LONGEST_KEPT:
                passing.append(w)
        rows = list(map(young.__getitem__, words))
        for w in passing:
            del young[w]
        losses = [r[0] for r in rows]
        # The n - 1 smallest losses bound what can matter.
        bar = heapq.nsmallest(self.n - 1, losses)[-1] if 1 < self.n <= len(rows) else float("inf")
        ways: list[tuple[float, tuple]] = [(0.0, ())]  # (loss, ((word, which), ...)): choices that deviate from the best
        for k in [k for k, loss in enumerate(losses) if loss <= bar] if self.n > 1 else []:
            more = ways + [(g + loss, (*way, (k, c))) for c, (loss, _, _) in enumerate(self.others(words[k])) for g, way in ways]
            more.sort(key=itemgetter(0))
            ways = more[: self.n]
        total, right = sum([r[1] for r in rows]), [r[3] for r in rows]
        parts, wrong = [r[2] for r in rows], right.count(False)
        out = [(total, b"".join(parts), not wrong)]
        for loss, way in ways[1:]:
            own, bad = parts.copy(), wrong
            for k, c in way:
                _, own[k], fine = self.others(words[k])[c]
                bad += right[k] - fine
            out.append((total - loss, b"".join(own), not bad))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The text, in UTF-8, that ids (as :meth:`best` gives them) stand for."""
        return b"".join(map(self.raw.__getitem__, array(self.code, ids)))[1:]


def _segmented(batches: Iterator[pa.RecordBatch], path: str, n: int, digest: bool) -> Iterator[pa.RecordBatch]:
    model = segmenter(path, n)
    last = "ids_crc32" if digest else "ids"
    for batch in slices(batches, "text", 1 << 18):
        docs, ranks, scores, counts, ids, same = [], [], [], [], [], []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for rank, (score, found, right) in enumerate(model.best(text), 1):
                docs.append(doc)
                ranks.append(rank)
                scores.append(score)
                counts.append(len(found) // model.width)
                plain = np.frombuffer(found, model.code).astype("<u4").tobytes()
                ids.append(zlib.crc32(plain) if digest else plain)
                same.append(right)
        yield pa.record_batch([
            pa.array(docs, pa.int64()), pa.array(ranks, pa.int32()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()),
            pa.array(same, pa.bool_()), pa.array(ids, pa.int64() if digest else pa.binary())], names=["doc_id", "rank", "score", "n_tokens", "round_trip", last])


def n_best(docs: DataFrame, path: str, n: int = BEST, digest: bool = False) -> DataFrame:
    """The ``n`` best segmentations of every text of ``docs`` (doc_id, text;
    other columns are ignored): doc_id, rank (from 1), score, n_tokens,
    round_trip (the ids decode to the text), ids (little-endian, 4 bytes
    each) or, with ``digest``, their CRC-32.

    Fewer rows if a text has fewer segmentations; a null or empty text has
    one, without tokens.  A text that holds the space mark itself decodes to
    spaces there.  Equal scores come in a fixed order; rows with equal texts
    get equal results.  A character that no piece holds becomes its bytes, at
    a score below all others.  An empty table gives no rows.
    """
    importable(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    kind = "ids_crc32 long" if digest else "ids binary"
    return slim.mapInArrow(lambda it: _segmented(it, path, n, digest), f"doc_id long, rank int, score double, n_tokens long, round_trip boolean, {kind}")


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = segmenter(path, BEST)
    for batch in slices(batches, "ids", 1 << 20):
        texts = [None if ids is None else model.spelt(np.frombuffer(ids, "<u4").tolist()).removeprefix(b" ").decode(errors="replace")
                 for ids in batch.column("ids").to_pylist()]
        yield pa.record_batch([batch.column("key"), pa.array(texts, pa.string())], names=["key", "text"])


def decoded(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (ids as :func:`n_best` gives them, any other columns) with
    the ``text`` that the ids stand for in place of them.

    Null ids give a null text, no ids an empty one; bytes that are not UTF-8
    become replacement characters; an id that the model doesn't have ends the
    job.  Repeated rows stay; an empty table stays empty; a column that is
    already called text is replaced."""
    importable(encoded.sparkSession)
    others = [c for c in encoded.columns if c not in ("ids", "text")]
    packed = encoded.select(F.struct(F.lit(0).alias("at"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)]).alias("key"), "ids")
    kind = packed.schema["key"].dataType.simpleString()
    out = packed.mapInArrow(lambda it: _decoded(it, path), f"key {kind}, text string")
    return out.select(*[F.col(f"key.c{k}").alias(c) for k, c in enumerate(others)], "text")


def op9_n_best_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of all documents."""
    return n_best(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
