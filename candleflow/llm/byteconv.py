"""Quality score of a document: a convolutional network over its bytes.

Every byte has a fixed code of a few numbers.  Learned filters look at eight
bytes, four bytes apart, over the whole text; chunks of 64 such windows, half
overlapping, take each filter's maximum; a small layer over a chunk's maxima
is pooled by its maximum over all chunks, and those combine into one
probability.  Trained in numpy by plain back-propagation: maxima send their
gradient to the window that won.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.llm.common import importable, load, slices

FILTERS, UNITS, HALF = 32, 16, 32
#: The fit uses about so many documents of each class, of so many bytes in all.
FIT_PER_CLASS, FIT_BYTES = 1000, 8 << 20
EPOCHS, BATCH, RATE = 6, 32, 4e-3
#: Bytes of text scored at once: a byte takes about 150 bytes of arrays, which every Python worker of an executor holds.
SCORE_BYTES = 1 << 17
KEEP_FROM = 0.7
LOW = np.float32(-1e9)


def _codes() -> np.ndarray:
    """Fixed byte codes (256: padding): kinds of characters, and four numbers that tell letters of any case apart."""
    b = np.arange(256)
    upper, lower = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122)
    digit, space, high = (b >= 48) & (b <= 57), (b == 32) | ((b >= 9) & (b <= 13)), b >= 128
    sign = ~(upper | lower | digit | space | high)
    folded = np.where(upper, b + 32, b)
    spread = np.random.default_rng(11).normal(0, 0.7, (256, 4))[folded]
    codes = np.zeros((257, 10), np.float32)
    codes[:256] = np.column_stack([upper, lower, digit, space, sign, high, spread])
    return codes


CODES = _codes()
DIM = 4 * CODES.shape[1]


@dataclass
class Network:
    """Weights; ``bias`` of the output and ``prior`` apart, so that a balanced
    fit sample still gives the probability under the real shares."""

    wide: np.ndarray  # DIM x 2 * FILTERS: the filters' first and last four bytes
    b1: np.ndarray
    w2: np.ndarray  # FILTERS + 1 x UNITS: the last row weighs how full the chunk is
    b2: np.ndarray
    w3: np.ndarray
    b3: np.ndarray
    prior: float = 0.0

    @classmethod
    def start(cls, seed: int = 5) -> "Network":
        rng = np.random.default_rng(seed)

        def draw(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        return cls(draw(DIM, 2 * FILTERS), np.zeros(FILTERS, np.float32), draw(FILTERS + 1, UNITS),
                   np.full(UNITS, 0.1, np.float32), draw(UNITS, 1)[:, 0], np.zeros(1, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.wide, self.b1, self.w2, self.b2, self.w3, self.b3]


@dataclass
class Layout:
    """Texts laid end to end in units of four bytes, each padded to two units
    at least; where the halves and chunks of each begin."""

    symbols: np.ndarray
    last: np.ndarray  # last unit of each text: no window begins there
    halves: np.ndarray  # first unit of each half chunk
    left: np.ndarray  # halves of each chunk; equal if a text has only one
    right: np.ndarray
    fill: np.ndarray  # share of a chunk's windows that exist
    first: np.ndarray  # first chunk of each text

    @classmethod
    def of(cls, texts: list[bytes]) -> "Layout":
        units = np.maximum(2, -(-np.array([len(t) for t in texts], np.int64) // 4))
        ends = np.cumsum(units)
        begin = ends - units
        symbols = np.full(4 * int(ends[-1]), 256, np.int16)
        for at, t in zip((4 * begin).tolist(), texts, strict=True):
            symbols[at : at + len(t)] = np.frombuffer(t, np.uint8)
        windows = units - 1
        per = -(-windows // HALF)
        doc = np.repeat(np.arange(len(texts)), per)
        inside = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        halves = begin[doc] + HALF * inside
        held = np.minimum(HALF, windows[doc] - HALF * inside)
        paired = inside + 1 < per[doc]
        chunk = paired | (per[doc] == 1)
        left = np.flatnonzero(chunk)
        right = left + paired[left]
        fill = (held[left] + np.where(paired[left], held[right], 0)) / (2 * HALF)
        first = np.concatenate([[0], np.cumsum(np.maximum(per - 1, 1))[:-1]])
        return cls(symbols, ends - 1, halves, left, right, fill.astype(np.float32), first)


def _windows(net: Network, lay: Layout) -> tuple[np.ndarray, np.ndarray]:
    x = CODES[lay.symbols].reshape(-1, DIM)
    both = x @ net.wide
    h = both[:, :FILTERS]
    h[:-1] += both[1:, FILTERS:]
    h[lay.last] = LOW
    return x, h


def _chunks(net: Network, halves: np.ndarray, lay: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    g = np.maximum(halves + net.b1, 0)
    c = np.column_stack([np.maximum(g[lay.left], g[lay.right]), lay.fill])
    return g, c, np.maximum(c @ net.w2 + net.b2, 0)


def logits(net: Network, texts: list[bytes]) -> np.ndarray:
    lay = Layout.of(texts)
    _, h = _windows(net, lay)
    _, _, z = _chunks(net, np.maximum.reduceat(h, lay.halves, axis=0), lay)
    return np.maximum.reduceat(z, lay.first, axis=0) @ net.w3 + net.b3[0]


def gradients(net: Network, texts: list[bytes], labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss of a batch and its gradient by each of the parameters."""
    lay = Layout.of(texts)
    x, h = _windows(net, lay)
    halves = np.maximum.reduceat(h, lay.halves, axis=0)
    g, c, z = _chunks(net, halves, lay)
    n = len(texts)
    stops = np.append(lay.first[1:], len(z))
    won = np.stack([a + np.argmax(z[a:b], axis=0) for a, b in zip(lay.first, stops, strict=True)])  # text x unit: its chunk
    unit = np.broadcast_to(np.arange(UNITS), won.shape)
    top = z[won, unit]
    logit = top @ net.w3 + net.b3[0]
    p = 1 / (1 + np.exp(-logit))
    loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
    d_logit = ((p - labels) / n).astype(np.float32)
    d_top = d_logit[:, None] * net.w3 * (top > 0)
    d_z = np.zeros_like(z)
    np.add.at(d_z, (won, unit), d_top)
    d_c = (d_z @ net.w2.T)[:, :FILTERS]
    to_left = g[lay.left] >= g[lay.right]
    d_g = np.zeros_like(g)
    np.add.at(d_g, lay.left, d_c * to_left)
    np.add.at(d_g, lay.right, d_c * ~to_left)
    d_g *= g > 0
    used = np.flatnonzero(d_g.any(axis=1))
    ends = np.append(lay.halves[1:], len(h))
    rows = np.stack([lay.halves[k] + np.argmax(h[lay.halves[k] : ends[k]], axis=0) for k in used]) if len(used) else np.zeros((0, FILTERS), np.int64)
    half, filt = np.nonzero(d_g[used])
    row, part = rows[half, filt], d_g[used][half, filt][:, None]
    d_wide = np.zeros_like(net.wide.T)
    np.add.at(d_wide, filt, part * x[row])
    np.add.at(d_wide, filt + FILTERS, part * x[row + 1])
    return loss, [d_wide.T, d_g.sum(axis=0), c.T @ d_z, d_z.sum(axis=0), (d_logit[:, None] * top).sum(axis=0), np.array([d_logit.sum()], np.float32)]


def fit(texts: list[bytes], labels: np.ndarray, prior: float = 0.0, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> Network:
    """Adam over shuffled batches with a falling rate; the same input gives the same network."""
    net = Network.start(seed)
    net.prior = prior
    rng = np.random.default_rng(seed)
    mean, square = [np.zeros_like(p) for p in net.parameters()], [np.zeros_like(p) for p in net.parameters()]
    step, steps = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            _, grads = gradients(net, [texts[i] for i in pick], labels[pick])
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for p, d, m, s in zip(net.parameters(), grads, mean, square, strict=True):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                p -= now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = FIT_PER_CLASS, max_bytes: int = FIT_BYTES) -> Network | float:
    """Fit on a bounded sample: of the labelled documents that aren't held
    out, about ``per_class`` of each class, chosen by a hash of the doc_id
    whatever their length, as long as a class has at most ``max_bytes`` bytes
    (its shortest text if none fits).  Documents with contradicting labels are
    left out.  If a class has no text at all, the share of ones (with one row
    of each class added) is returned for want of a network."""
    importable(docs.sparkSession)
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).alias("y"), F.max(label).alias("hi")).where("y = hi").drop("hi"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    share = (ones + 1) / (zeros + ones + 2)
    if not zeros or not ones:
        return share
    fine = 1_000_000
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(fine))
    chosen = known.where(place < F.when(F.col("y") == 0, fine * per_class / zeros).otherwise(fine * per_class / ones)).limit(3 * per_class)
    text = F.coalesce("text", F.lit(""))
    # The chosen rows are bounded by the line above; their texts are fetched once their sizes are known.
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
             .join(F.broadcast(chosen), "doc_id"))
    sizes = found.select("doc_id", "y", "h", F.octet_length("text").alias("n")).distinct().limit(3 * per_class).collect()
    keys = []
    for y in (0, 1):
        mine, total = sorted((r for r in sizes if r["y"] == y), key=lambda r: (r["doc_id"], r["h"])), 0
        fitting = []
        for r in mine:
            if total + r["n"] <= max_bytes:
                fitting.append((r["doc_id"], r["h"]))
                total += r["n"]
        keys += fitting or [(r["doc_id"], r["h"]) for r in sorted(mine, key=lambda r: r["n"])[:1]]
    if not keys:
        return share
    wanted = docs.sparkSession.createDataFrame(keys, "doc_id long, h long")
    rows = found.join(F.broadcast(wanted), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).select("doc_id", "text", "y").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    y = np.array([r["y"] for r in rows], np.float32)
    if y.min() == y.max():
        return share
    # The sample's shares are known; the output is moved to those of all labelled rows.
    prior = float(np.log(ones / zeros) - np.log(y.sum() / (len(y) - y.sum())))
    return fit([r["text"].encode() for r in rows], y, prior)


def _probabilities(net: Network | float, texts: list[str | None]) -> np.ndarray:
    if isinstance(net, float):
        return np.full(len(texts), net)
    return 1 / (1 + np.exp(-(logits(net, [(t or "").encode() for t in texts]).astype(np.float64) + net.prior)))


def _scored(batches: Iterator[pa.RecordBatch], net: Network | float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SCORE_BYTES):
        yield pa.record_batch([batch.column("doc_id"), pa.array(_probabilities(net, batch.column("text").to_pylist()))], names=["doc_id", "score"])


def _passed(batches: Iterator[pa.RecordBatch], net: Network | float, least: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SCORE_BYTES):
        yield batch.filter(pa.array(_probabilities(net, batch.column("text").to_pylist()) >= least))


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, held_out, score, predicted.  A null text counts as empty; an
    empty one is scored as padding alone.  The score depends on the text only,
    so repeated rows score alike."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = slim.mapInArrow(lambda it: _scored(it, net), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def passing(docs: DataFrame, net: Network | float, least: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more.
    Without a network (a class without text) nothing is known against any row,
    and all stay.  Repeated rows go or stay together; an empty table stays so."""
    if isinstance(net, float):
        return docs
    return docs.mapInArrow(lambda it: _passed(it, net, least), docs.schema)


def op1_byte_conv_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a network trained on the labels."""
    docs = load(spark, sf_dir, "documents")
    return score(docs, train(docs, load(spark, sf_dir, "labels")))
