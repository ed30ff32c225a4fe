"""Ranked lexical search by dense blocked matrix products.

The terms of the items make a compact vocabulary.  One scan of the documents
keeps, per document, its length and its counts of those terms.  Items come in
tiles, each with the terms of its own items only; documents come in tiles of
``TILE`` rows.  A tile of documents is a dense matrix of impacts (terms times
documents), a tile of items one of weights (items times terms), and their
product, by BLAS in float64, holds the scores.  All entries are whole numbers,
and a tile of terms ends before the largest sum it could give reaches 2^53, so
every partial sum is exact in whatever order BLAS adds; sums of several tiles
are added as 64-bit integers.

Each task keeps the k best documents of every item over all its tiles, ties by
doc_id included, so a few rows per item and task are left to merge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleflow.llm.common import load
from candleflow.session import materialize

TOP_K = 10
#: Documents, items and terms of a tile (32 MB of doubles at most).
TILE, ITEMS, TERMS = 1024, 256, 4096
#: Terms that the items of one pass over the documents hold, about: what is
#: sent to the tasks.  More items take more passes.
PASS_TERMS = 400_000
#: Bytes of a text that are cut into terms at a time, about.
STRETCH = 1 << 20
EXACT = 1 << 53
IMPACT_LIMIT = 1_000_000  # every impact is below it
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes that are part of a term, lower-cased; a space for all others.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of about STRETCH bytes."""
    lo = 0
    while lo < len(text):
        parts, hi = [], lo
        while hi < len(text):
            parts.append(text[hi : hi + STRETCH].translate(_TERM_BYTES))
            hi += STRETCH
            if hi < len(text) and (end := parts[-1].rfind(b" ")) >= 0:  # a term that goes on starts the next list
                hi -= len(parts[-1]) - end - 1
                parts[-1] = parts[-1][: end + 1]
                break
        yield b"".join(parts).split()
        lo = hi


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, n: the terms of all items with their counts.  The
    different texts of one item_id add up, equal rows count once."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    return rows.select("item_id", F.explode(words).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("n"))


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (its terms) and, as packed 32-bit
    and 64-bit integers, the vocabulary terms it holds and how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            lengths, held, counts = [], [], []
            for text in batch.column(1):
                raw, n, parts = text.as_buffer(), 0, []
                for words in terms(raw.to_pybytes()) if raw is not None else ():
                    n += len(words)
                    found = np.fromiter((k for k in map(number, words) if k is not None), dtype=np.int32)
                    parts.append(np.unique(found, return_counts=True))
                if len(parts) == 1:
                    which, times = parts[0]
                elif parts:
                    which, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    times = np.bincount(place, np.concatenate([p[1] for p in parts]), len(which))
                else:
                    which = times = np.zeros(0, np.int32)
                lengths.append(n)
                held.append(which.astype("<i4").tobytes())
                counts.append(times.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(held, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "held", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, held binary, counts binary")


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """df of every vocabulary term: each task adds up its documents first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["term", "df"])

    df = np.zeros(size, np.int64)
    for r in rows.select("held").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


@dataclass
class ItemTile:
    """Items with the blocks of their terms: for each the term numbers, and the
    weights as (place of the item, place of the term, weight)."""

    ids: np.ndarray  # numbers of the items
    blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def item_tiles(pairs: list[tuple[int, int, int]], weights: np.ndarray, n_items: int, per_tile: int = ITEMS, per_block: int = TERMS, exact: int = EXACT) -> list[ItemTile]:
    """Tiles of items from (item, term, count).  A block of terms is closed at
    ``per_block`` terms, or before a score of one of its items could reach
    ``exact``; a weight too large for one block is spread over several."""
    most = (exact - 1) // IMPACT_LIMIT
    by_tile: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(-(-n_items // per_tile))]
    for item, term, count in pairs:
        if weights[term]:
            by_tile[item // per_tile].setdefault(term, []).append((item % per_tile, int(weights[term]) * count))
    tiles = []
    for t, held in enumerate(by_tile):
        ids = np.arange(t * per_tile, min(n_items, (t + 1) * per_tile))
        left, blocks = sorted(held.items()), []
        while left:
            sums, columns, later = np.zeros(len(ids), np.int64), [], []
            for term, entries in left:
                room = len(columns) < per_block
                now = [(i, min(w, most - int(sums[i]))) for i, w in entries] if room else []
                now = [(i, w) for i, w in now if w > 0]
                if now:
                    columns.append((term, now))
                    for i, w in now:
                        sums[i] += w
                taken = dict(now)
                rest = [(i, w - taken.get(i, 0)) for i, w in entries if w > taken.get(i, 0)]
                if rest:
                    later.append((term, rest))
            cells = np.array([(i, c, w) for c, (_, entries) in enumerate(columns) for i, w in entries], np.int64).reshape(-1, 3)
            blocks.append((np.array([c[0] for c in columns], np.int32), *cells.T))
            left = later
        tiles.append(ItemTile(ids, blocks))
    return tiles


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def ranked(rows: DataFrame, tiles: list[ItemTile], size: int, n_items: int, n_docs: int, n_terms: int, k: int, tile: int = TILE) -> DataFrame:
    """item (its number), doc_id, score, known: the k best of each task."""
    shared = rows.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))  # item, score, doc_id, known
        floor = np.ones(n_items, np.int64)  # the least score that could still be among the k best
        at = np.full(size, -1, np.int32)
        for batch in batches:
            for lo in range(0, batch.num_rows, tile):
                part = batch.slice(lo, tile)
                held = part.column("held").to_pylist()
                term = np.frombuffer(b"".join(held), "<i4")
                doc = np.repeat(np.arange(len(held)), [len(h) // 4 for h in held])
                tf = np.frombuffer(b"".join(part.column("counts").to_pylist()), "<i8")
                n = part.column("n").to_numpy()
                impact = impacts(tf, n[doc], n_docs, n_terms).astype(np.float64)
                known = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                doc_id = part.column("doc_id").fill_null(0).to_numpy()
                for items in shared.value:
                    scores = np.zeros((len(items.ids), len(held)), np.int64)
                    for columns, i, c, w in items.blocks:
                        weights = np.zeros((len(items.ids), len(columns)))
                        weights[i, c] = w
                        at[columns] = np.arange(len(columns))
                        row = at[term]
                        inside = row >= 0
                        dense = np.zeros((len(columns), len(held)))
                        dense[row[inside], doc[inside]] = impact[inside]
                        scores += (weights @ dense).astype(np.int64)
                        at[columns] = -1
                    i, d = np.nonzero(scores >= floor[items.ids][:, None])
                    if len(i):
                        best = tuple(map(np.concatenate, zip(best, (items.ids[i], scores[i, d], doc_id[d], known[d]))))
                best = cut(best, k)
                last = np.append(best[0][1:] != best[0][:-1], True)[: len(best[0])]  # of each item, its k-th if it has so many
                full = np.bincount(best[0], minlength=n_items)[best[0]] >= k
                floor[best[0][last & full]] = best[1][last & full]
        yield pa.RecordBatch.from_arrays([pa.array(best[0]), pa.array(best[2], mask=~best[3]), pa.array(best[1])], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def cut(best: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The k best of each item, equal scores by doc_id, unknown ones last."""
    item, score, doc_id, known = best
    order = np.lexsort((doc_id, ~known, -score, item))
    item = item[order]
    first = np.searchsorted(item, item)
    keep = order[np.arange(len(item)) - first < k]
    return tuple(x[keep] for x in best)


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K, pass_terms: int = PASS_TERMS) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` (doc_id, text) for each item
    (item_id, text): item_id, rank (from 1), doc_id, score.

    Terms, weights and scores are those of the contract of
    ``op11_ranked_search``.  Null and empty texts have no terms; such
    documents count nowhere and such items give no rows, nor does an empty
    table.  Only scores above 0 are returned.  Equal scores stand by ascending
    doc_id, a null doc_id last; rows that repeat a doc_id are documents of
    their own.  Rows that repeat an item_id are one item (equal ones once,
    different texts together); a null item_id is an item like any other.
    Other columns are ignored.

    What the driver holds and sends out grows with the items of one pass,
    about ``pass_terms`` (item, term) pairs; more items are split by a hash
    into passes, each a scan of its own.  The documents are never collected.
    """
    spark = docs.sparkSession
    pairs = materialize(item_terms(items), "search-items")
    passes = max(1, -(-pairs.count() // pass_terms))
    results = []
    for p in range(passes):
        mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).collect() if passes > 1 else pairs.collect()
        ids = sorted({r["item_id"] for r in mine}, key=lambda i: (i is not None, i or 0))
        number = {i: k for k, i in enumerate(ids)}
        vocabulary = {t: k for k, t in enumerate(sorted({r["term"].encode() for r in mine}))}
        rows = materialize(counted(docs, vocabulary), "search-counts")
        total = rows.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms")).first()
        df = document_counts(rows, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * total["n_docs"] + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)
        tiles = item_tiles([(number[r["item_id"]], vocabulary[r["term"].encode()], r["n"]) for r in mine], weights, len(ids))
        found = ranked(rows.where("octet_length(held) > 0"), tiles, len(vocabulary), len(ids), total["n_docs"], max(1, total["n_terms"]), k)
        results.append(_merged(materialize(found, "search-found"), k).join(
            F.broadcast(spark.createDataFrame([(k, i) for i, k in number.items()], "item long, item_id long")), "item"))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out.select("item_id", "rank", "doc_id", "score")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks: first of the tasks by turns, then of those."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("salt")
    first = found.select("*", salt).withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("salt")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def oracle_sql() -> str:
    """The same in DuckDB, term by term."""
    words = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}')"
    return f"""
with d as (select row_number() over () as row_id, doc_id, unnest({words}) as term from documents),
q as (select item_id, term, count(*)::bigint as times from (select item_id, unnest({words}) as term from (select distinct item_id, text from benchmark)) group by 1, 2),
sizes as (select row_id, any_value(doc_id) as doc_id, count(*)::bigint as n from d group by row_id),
total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from sizes),
tf as (select row_id, term, count(*)::bigint as tf from d semi join q using (term) group by 1, 2),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, total group by term, n_docs),
scored as (
  select item_id, row_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::bigint as score
  from q join w using (term) join tf using (term) join sizes using (row_id), total group by item_id, row_id, doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank, doc_id, score from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= {TOP_K}
"""
