"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A document is the multiset of its five-word shingles.  For every shingle the
weight axis 0, 1, 2, ... is cut into blocks [0,1), [1,2), [2,4), [4,8), ...;
each block carries a Poisson process whose points have a time, a place in the
block and one of ``m`` components, all drawn from hashes of shingle, block and
point number.  A document sees the points below its weight; the earliest one
of each component is its signature, so two signatures agree in a component
with exactly the probability sum(min) / sum(max) of the weights.  Points are
made in order of time, and a block is left once it is past the latest of the
document's components: about ``m ln m`` points a document plus one a block,
not ``m`` for each unit of weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.llm.common import components, importable, load, mix64, slices
from candleflow.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
STEP = 1 << 20
#: Members of a bucket compared with each other at once, and how many standard
#: deviations below the threshold a signature's estimate may be.
BLOCK, SIGMAS = 1024, 4.0
#: Pieces of work that small buckets share, at least.
PIECES = 64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_COEFFICIENTS = mix64(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)


def _word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run of bytes without ASCII white space)."""
    b = np.frombuffer(data, np.uint8)
    space = _SPACE[b]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b), _BASE, np.uint64)]), dtype=np.uint64)
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b), _INVERSE, np.uint64)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    return mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def words_by_text(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in lower case, and each text's word count.  A
    long text is hashed in stretches cut at white space."""
    out: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    waiting: list[bytes] = []
    numbers: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if waiting:
            data = b"\n".join(waiting)
            hashes = _word_hashes(data)
            out.append(hashes)
            b = np.frombuffer(data, np.uint8)
            begin = ~_SPACE[b] & np.concatenate([[True], _SPACE[b[:-1]]]) if len(b) else np.zeros(0, bool)
            ends = np.cumsum([len(w) + 1 for w in waiting]) - 1
            per = np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(begin)])[ends]]))
            np.add.at(counts, numbers, per)
        waiting.clear()
        numbers.clear()
        held = 0

    for k, text in enumerate(texts):
        data = (text or "").lower().encode()
        at = 0
        while at < len(data):
            stop = at + STEP
            while stop < len(data) and not _SPACE[data[stop]]:
                stop += 1
            waiting.append(data[at:stop])
            numbers.append(k)
            held += stop - at
            at = stop
            if held >= STEP:
                flush()
    flush()
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count), sorted.  A text of fewer words than
    ``size`` is one shingle of all its words; one without words has none."""
    words, counts = words_by_text(texts)
    text = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    inside = np.arange(len(words)) - first[text]
    whole = counts[text] >= size
    at = np.flatnonzero(np.where(whole, inside + size <= counts[text], inside == 0))
    total = np.zeros(len(at), np.uint64)
    left = np.minimum(counts[text[at]], size)
    for k in range(size):
        use = left > k
        total[use] += words[at[use] + k] * _COEFFICIENTS[k]
    total = mix64(total + left.astype(np.uint64))
    order = np.lexsort((total, text[at]))
    t, h = text[at][order], total[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])]) if len(t) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    return t[begin], h[begin], np.diff(np.concatenate([begin, [len(t)]]))


def signatures(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, m: int) -> np.ndarray:
    """BagMinHash signatures, n x m: the name of the earliest point of each
    component.  ``text`` ascending in 0..n-1; texts without shingles get 0."""
    best = np.full(n * m, np.inf)
    names = np.zeros(n * m, np.uint64)
    levels = 1 + np.ceil(np.log2(weights)).astype(np.int64) if len(weights) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(levels) - levels, levels)
    start = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    size = np.maximum(start, 1)
    doc, room = text[owner], weights[owner] - start
    seed = mix64(hashes[owner] + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
    rate = size.astype(np.float64) * m
    time, point = np.zeros(len(owner)), 0
    while len(doc):
        ahead = int(np.clip((1 << 16) // len(doc), 1, 64))  # few blocks left: several points of each at once
        number = np.arange(point, point + ahead, dtype=np.uint64) + np.uint64(1)
        draw = mix64(seed[:, None] + number[None, :] * _BASE)
        gaps = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        name = mix64(draw ^ np.uint64(0xA24BAED4963EE407))
        component = (((name >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        place = ((name & np.uint64(0xFFFFFFFF)).astype(np.int64)) & (size - 1)[:, None]
        seen = place < room[:, None]
        key = (doc[:, None] * m + component)[seen]
        t, who = times[seen], name[seen]
        order = np.lexsort((t, key))
        key, t, who = key[order], t[order], who[order]
        lead = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        key, t, who = key[lead], t[lead], who[lead]
        better = t < best[key]
        best[key[better]], names[key[better]] = t[better], who[better]
        latest = best.reshape(n, m).max(axis=1)
        time = times[:, -1]
        going = time < latest[doc]
        doc, seed, rate, time, size, room = doc[going], seed[going], rate[going], time[going], size[going], room[going]
        point += ahead
    return names.reshape(n, m)


class Bags:
    """The shingle multisets of some texts, for comparing many pairs of them."""

    def __init__(self, texts: list[str | None], size: int = SHINGLE):
        t, self.hashes, self.counts = shingles(texts, size)
        self.total = np.bincount(t, self.counts, len(texts))
        self.length = np.bincount(t, minlength=len(texts))
        self.start = np.cumsum(self.length) - self.length

    def overlap(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of each pair of text numbers."""
        n = len(left)
        both = np.concatenate([left, right])
        length = self.length[both]
        pair = np.repeat(np.arange(2 * n) % max(n, 1), length)
        at = np.arange(len(pair)) + np.repeat(self.start[both] - (np.cumsum(length) - length), length)
        h, c = self.hashes[at], self.counts[at]
        order = np.lexsort((h, pair))
        pair, h, c = pair[order], h[order], c[order]
        same = (pair[1:] == pair[:-1]) & (h[1:] == h[:-1])
        shared = np.bincount(pair[1:][same], np.minimum(c[1:], c[:-1])[same], n)
        union = self.total[left] + self.total[right] - shared
        return np.divide(shared, union, out=np.zeros(n), where=union > 0)


def overlap(left: list[str], right: list[str], size: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts, from the multisets."""
    n = len(left)
    return Bags([*left, *right], size).overlap(np.arange(n), np.arange(n, 2 * n))


def _signed(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    m = bands * rows
    for batch in slices(batches, "text", 2 << 20):
        t, h, c = shingles(batch.column("text").to_pylist(), size)
        n = batch.num_rows
        names = signatures(t, h, c, n, m)
        short = [x.tobytes() for x in (names & np.uint64(255)).astype(np.uint8)]
        names = names.reshape(n, bands, rows)
        key = np.zeros((n, bands), np.uint64)
        for r in range(rows):
            key = mix64(key + names[:, :, r] * _COEFFICIENTS[r])
        flat = pa.array(key.view(np.int64).reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), flat)
        weight = np.bincount(t, c, n).astype(np.int64)
        yield pa.record_batch([batch.column("doc_id"), batch.column("h1"), batch.column("h2"), pa.array(weight), lists, pa.array(short, pa.binary())],
                              names=["doc_id", "h1", "h2", "n", "bands", "sig"])


def _similar(batches: Iterator[pa.RecordBatch], size: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text_a", 2 << 20):
        s = overlap(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), size)
        yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(s >= threshold - 1e-12)], names=["a", "b", "link"])


def _linked(rows: pd.DataFrame, threshold: float, size: int) -> pd.DataFrame:
    """Links between groups within the buckets of a piece of work, or between
    the two blocks of one: pairs whose signatures agree about as often as the
    threshold asks, verified on their texts.  A pair is looked at in the first
    bucket it shares.  Of the links, as many come out as tie the linked
    members together."""
    out = []
    for (band, _), part in rows.groupby(["band", "bucket"]):
        ids, root, n, block = (part[c].to_numpy() for c in ("id", "root", "n", "block"))
        sig = np.frombuffer(b"".join(part["sig"]), np.uint8).reshape(len(ids), -1)
        keys = np.stack(part["bands"])
        m = sig.shape[1]
        least = int(np.floor(m * threshold - SIGMAS * np.sqrt(m * threshold * (1 - threshold))))
        split = part["lo"].iat[0] != part["hi"].iat[0]
        bags, head = None, list(range(len(ids)))

        def find(x: int) -> int:
            while head[x] != x:
                head[x] = head[head[x]]
                x = head[x]
            return x

        for lo in range(0, len(ids), 64):
            i = slice(lo, lo + 64)
            near = (ids[i, None] < ids[None, :]) & (root[i, None] != root[None, :])
            near &= np.minimum(n[i, None], n[None, :]) >= threshold * np.maximum(n[i, None], n[None, :]) - 1e-9
            if split:
                near &= block[i, None] != block[None, :]
            x, y = np.nonzero(near)
            x = x + lo
            for at in range(0, len(x), 1 << 13):
                u, v = x[at : at + (1 << 13)], y[at : at + (1 << 13)]
                same = sig[u] == sig[v]
                before = (keys[u, :band] == keys[v, :band]).any(axis=1)
                good = (same.sum(axis=1) >= least) & ~before
                u, v = u[good], v[good]
                if len(u) and bags is None:
                    bags = Bags(part["text"].tolist(), size)
                for k in range(0, len(u), 256):
                    linked = bags.overlap(u[k : k + 256], v[k : k + 256]) >= threshold - 1e-12
                    for a, b in zip(u[k : k + 256][linked].tolist(), v[k : k + 256][linked].tolist(), strict=True):
                        if (p := find(a)) != (q := find(b)):
                            head[max(p, q)] = min(p, q)
                            out.append((ids[a], ids[b]))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def text_hashes() -> list[F.Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(5), text).alias("h2")]


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, class_id (smallest doc_id with the same text), group_id (smallest
    doc_id that links lead to), kept (doc_id = group_id).

    Texts link when the weighted Jaccard similarity of their shingle multisets
    is at least ``threshold``; words are runs without ASCII white space, in
    lower case.  A document without words, null or empty, links with nothing
    and is kept; one of fewer than ``size`` words is a single shingle.  Rows
    with a null doc_id take no part and are kept; rows that repeat a doc_id
    are one document.  An empty table gives no rows.  ``with_text`` adds the
    two hashes h1, h2 of the row's text (``text_hashes``) and whether it has
    words (``worded``), for rows that share a doc_id with other texts.

    Equal texts meet by hash, summed within tasks, and only one of each goes
    on.  In a band's bucket the members are verified against the one that
    shares most buckets with others: a bucket of thousands of copies costs a
    pair a member.  Members whose groups still differ are then compared with
    each other, block against block: by their signatures, and on their texts
    if those agree as often as the threshold less ``SIGMAS`` standard
    deviations asks.  Only links that join groups are written.
    """
    spark = docs.sparkSession
    importable(spark)
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *text_hashes())
    signed = materialize(base.where("doc_id is not null and text <> ''").mapInArrow(
        lambda it: _signed(it, size, bands, rows), "doc_id long, h1 long, h2 long, n long, bands array<long>, sig binary").where("n > 0"), "signatures")
    classes = materialize(signed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "text-classes")

    members = classes.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("band", "bucket").agg(F.count("*").alias("c")).where("c > 1")
    bucketed = materialize(members.join(shared, ["band", "bucket"]), "buckets")
    weight = bucketed.groupBy("id").agg(F.sum(F.col("c") - 1).alias("deg"))
    bucketed = materialize(bucketed.join(weight, "id"), "weighed-buckets")
    ids = weight.select("id")
    one_text = classes.select("id", "h1", "h2").join(ids, "id", "left_semi")
    texts = materialize(base.join(one_text.select(F.col("id").alias("doc_id"), "h1", "h2"), ["doc_id", "h1", "h2"], "left_semi")
                        .dropDuplicates(["doc_id", "h1", "h2"]).select("doc_id", "text"), "candidate-texts")

    where = ["band", "bucket"]
    lead = bucketed.groupBy(*where).agg(F.max(F.struct("deg", (-F.col("id")).alias("minus"), "n")).alias("l")).select(
        *where, (-F.col("l.minus")).alias("leader"), F.col("l.n").alias("n_l"))
    stars = (bucketed.join(lead, where).where("id <> leader")
             .where(F.least("n", "n_l") >= threshold * F.greatest("n", "n_l") - 1e-9)
             .select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct())
    joined = (stars.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))
    first = materialize(joined.select("a", "b", "text_a", "text_b").mapInArrow(
        lambda it: _similar(it, size, threshold), "a long, b long, link boolean").where("link").select("a", "b"), "star-links")
    groups = components(first)

    labelled = bucketed.where("c > 2").join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = labelled.groupBy(*where).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select(*where)
    apart = materialize(labelled.join(mixed, where, "left_semi"), "mixed-buckets")
    if left := apart.count():
        placed = apart.withColumn("blocks", F.ceil(F.col("c") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        whole = placed.join(classes.select("id", "sig", "bands"), "id").join(texts.withColumnRenamed("doc_id", "id"), "id")
        work = whole.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
            *where, "id", "n", "root", "sig", "bands", "text", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(*where), F.lit(max(PIECES, left // BLOCK)))).otherwise(F.xxhash64(*where)).alias("piece"))
        more = materialize(work.groupBy("piece", "lo", "hi").applyInPandas(lambda pdf: _linked(pdf, threshold, size), "a long, b long"), "cross-links")
        groups = components(first.union(more))

    of_text = classes.select("h1", "h2", F.col("id").alias("class_id")).join(groups.select(F.col("id").alias("class_id"), "root"), "class_id", "left")
    out = base.select("doc_id", "h1", "h2").join(of_text, ["h1", "h2"], "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    group_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "class_id", "doc_id"))
    more = ["h1", "h2", F.col("class_id").isNotNull().alias("worded")] if with_text else []
    return out.select("doc_id", class_id.alias("class_id"), group_id.alias("group_id"), F.coalesce(F.col("doc_id") == group_id, F.lit(True)).alias("kept"), *more)


def op8_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents among all documents."""
    return near_duplicates(load(spark, sf_dir, "documents"))
