"""Nearest neighbours by an adaptive dimension scan of inverted lists.

Vectors are scaled to length 1, rotated by a random orthogonal matrix and
dealt to the list of their nearest centre.  A query probes its nearest lists.
Within a list the rotated coordinates are scanned in column blocks: after d of
D coordinates the partial distance, scaled by D/d, estimates the whole one,
and a candidate whose estimate exceeds the query's current bound by more than
the error a random rotation allows is abandoned.  What survives is scored
exactly on the original vectors.  How far the queries probe is set by an
audit: some of them are answered by brute force first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleflow.llm.common import importable, load
from candleflow.llm.vectors import matrix, unit, usable
from candleflow.session import materialize

#: Vectors that the centres are fitted on, and the most centres.
FIT_ROWS, MAX_LISTS = 16_384, 1024
#: Queries answered by brute force, and the share of their neighbours that the probed lists must hold.
AUDIT, COVER = 64, 0.97
COLUMNS = 8
#: Width of the test: a candidate nearer than the bound is abandoned with a probability of about exp(-EPSILON**2).
EPSILON = 2.1
BLOCK_ROWS, BLOCK_QUERIES = 8192, 512


def rotation(dim: int, seed: int = 3) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def centres(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Spherical k-means over ``sample`` (unit rows)."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(sample @ found.T, axis=1)
        total = np.zeros_like(found)
        np.add.at(total, near, sample)
        lone = np.bincount(near, minlength=len(found)) == 0
        total[lone] = sample[rng.choice(len(sample), int(lone.sum()))]
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        found = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), found)
    return found


def scan(block: np.ndarray, queries: np.ndarray, bound: np.ndarray, columns: int = COLUMNS, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The (query, row, squared distance) of what no test abandons.  ``block``
    and ``queries``: rotated unit rows; ``bound``: squared distance per query."""
    dim = block.shape[1]
    edges = [*range(0, dim, columns), dim]
    head = slice(0, edges[1])
    part = ((queries[:, head] ** 2).sum(axis=1)[:, None] + (block[:, head] ** 2).sum(axis=1)[None, :] - 2 * queries[:, head] @ block[:, head].T)
    q, row = np.nonzero(_plausible(part, edges[1], dim, bound[:, None], epsilon))
    part = part[q, row]
    for lo, hi in zip(edges[1:-1], edges[2:], strict=True):
        part = part + ((queries[q, lo:hi] - block[row, lo:hi]) ** 2).sum(axis=1)
        alive = _plausible(part, hi, dim, bound[q], epsilon)
        q, row, part = q[alive], row[alive], part[alive]
    return q, row, part


def _plausible(part: np.ndarray, seen: int, dim: int, bound: np.ndarray, epsilon: float) -> np.ndarray:
    slack = 1.0 if seen == dim else (1 + epsilon / np.sqrt(seen)) ** 2
    return part * (dim / seen) <= bound * slack + 1e-9


def _best(pairs: pd.DataFrame, k: int) -> pd.DataFrame:
    pairs = pairs.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return pairs[pairs.groupby("query_id").cumcount() < k]


def _searched(rows: pd.DataFrame, asked: pd.DataFrame, turn: np.ndarray, k: int, step: int = 256) -> pd.DataFrame:
    out = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    if not len(rows) or not len(asked):
        return out
    ids, query_ids = rows["vec_id"].to_numpy(), asked["query_id"].to_numpy()
    x, y = unit(np.stack(rows["v"])), unit(np.stack(asked["v"]))
    block, queries = x @ turn, y @ turn
    bound = np.full(len(y), 8.0)  # more than any squared distance of unit vectors
    for lo in range(0, len(x), step):
        q, r, part = scan(block[lo : lo + step], queries, bound)
        r = r + lo
        other = ids[r] != query_ids[q]
        q, r = q[other], r[other]
        found = pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[r], "score": np.einsum("ij,ij->i", y[q], x[r])})
        out = _best(pd.concat([out, found]), k)
        worst = out.groupby("query_id")["score"].agg(["size", "min"])
        full = worst.index[worst["size"] == k]
        at = pd.Index(query_ids).get_indexer(full)
        bound[at] = np.maximum(2 - 2 * worst.loc[full, "min"].to_numpy(), 0)
    return out


def _dealt(batches: Iterator[pa.RecordBatch], dim: int, found: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = np.argmax(unit(matrix(batch.column("v"), dim)) @ found.T, axis=1)
        yield pa.record_batch([pa.array(near.astype(np.int32)), batch.column("vec_id"), batch.column("v")], names=["list", "vec_id", "v"])


def _probed(batches: Iterator[pa.RecordBatch], dim: int, found: np.ndarray, held: np.ndarray, enough: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        order = np.argsort(-(unit(matrix(batch.column("v"), dim)) @ found.T), axis=1, kind="stable")
        before = np.cumsum(held[order], axis=1) - held[order]
        row, col = np.nonzero(before < enough)
        yield pa.record_batch([pa.array(order[row, col].astype(np.int32)), batch.column("vec_id").take(pa.array(row)), batch.column("v").take(pa.array(row))], names=["list", "query_id", "v"])


def _brute(batches: Iterator[pa.RecordBatch], dim: int, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        others, lists = batch.column("vec_id").to_numpy(), batch.column("list").to_numpy()
        s = queries @ unit(matrix(batch.column("v"), dim)).T
        s[ids[:, None] == others[None, :]] = -2
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        q = np.repeat(np.arange(len(ids)), top.shape[1])
        c = top.reshape(-1)
        real = s[q, c] > -2
        q, c = q[real], c[real]
        yield pa.record_batch([pa.array(ids[q]), pa.array(others[c]), pa.array(lists[c]), pa.array(s[q, c])], names=["query_id", "vec_id", "list", "score"])


def _top(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(rows: DataFrame, is_query: F.Column, k: int = 5, column: str = "embedding", fit_rows: int = FIT_ROWS, max_lists: int = MAX_LISTS,
            audit: int = AUDIT, cover: float = COVER) -> DataFrame:
    """The ``k`` nearest found of each query (rows of ``rows`` for which
    ``is_query``, an expression of vec_id, holds) among all other rows by
    cosine, exact in double precision: query_id, rank (from 1), vec_id, score.

    Which vectors take part: see :func:`candleflow.llm.vectors.usable`.  Ties
    go to the smaller vec_id; with fewer than ``k`` other vectors all are
    returned; an empty table gives no rows.  Centres are fitted on a sample of
    about ``fit_rows``; every vector is in a list.  ``audit`` queries, chosen
    by a hash, are answered by brute force, and each query probes its nearest
    lists until they hold so many vectors that ``cover`` of the audited
    neighbours would be found.  A list is searched in blocks of rows and of
    queries, so a list with a third of all rows is many small pieces of work.
    """
    spark = rows.sparkSession
    importable(spark)
    ddl = "query_id long, vec_id long, score double"
    base, dim = usable(rows, column)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = materialize(base, "vectors")
    total = base.count()
    place = F.pmod(F.xxhash64("vec_id", F.lit(23)), F.lit(1_000_000))
    # A sample of bounded size: about fit_rows vectors.
    sample = base.where(place < 1e6 * min(1.0, fit_rows / total)).limit(2 * fit_rows).select("v").toArrow()["v"]
    sample = unit(matrix(sample, dim)) if len(sample) else unit(matrix(base.limit(1).toArrow()["v"], dim))
    found = centres(sample, min(max_lists, max(1, int(np.sqrt(total)))))
    lists = materialize(base.mapInArrow(lambda it: _dealt(it, dim, found), "list int, vec_id long, v array<double>"), "lists")
    held = np.zeros(len(found), np.int64)
    for r in lists.groupBy("list").count().collect():  # a row per list
        held[r["list"]] = r["count"]

    asked = lists.where(is_query)
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    some = F.pmod(F.xxhash64("vec_id", F.lit(29)), F.lit(1_000_000))
    audited = asked.where(some < 1e6 * min(1.0, audit / n_asked)).limit(2 * audit).select("vec_id", "v").toArrow()
    enough = total
    if audited.num_rows:
        ids, y = audited["vec_id"].to_numpy(), unit(matrix(audited["v"], dim))
        truth = _top(lists.mapInArrow(lambda it: _brute(it, dim, ids, y, k), "query_id long, vec_id long, list int, score double"), k).collect()
        order = np.argsort(-(y @ found.T), axis=1, kind="stable")
        before = np.cumsum(held[order], axis=1) - held[order]
        at = {int(i): n for n, i in enumerate(ids)}
        need = sorted(int(before[at[r["query_id"]], int(np.flatnonzero(order[at[r["query_id"]]] == r["list"])[0])]) + 1 for r in truth)
        enough = need[min(len(need) - 1, int(np.ceil(cover * len(need))))] if need else total
    enough = max(enough, k + 1)

    probes = materialize(asked.select("vec_id", "v").mapInArrow(lambda it: _probed(it, dim, found, held, enough), "list int, query_id long, v array<double>"), "probes")
    per = {r["list"]: r["count"] for r in probes.groupBy("list").count().collect()}
    cuts = spark.createDataFrame([(i, -(-int(held[i]) // BLOCK_ROWS), -(-n // BLOCK_QUERIES)) for i, n in per.items()], "list int, blocks int, turns int")
    left = (lists.join(F.broadcast(cuts), "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
            .select("list", "block", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "vec_id", "v"))
    right = (probes.join(F.broadcast(cuts), "list").withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int"))
             .where("blocks > 0").select("list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - F.lit(1).cast("long"))).alias("block"), "turn", "query_id", "v"))
    turn = rotation(dim)
    keys = ["list", "block", "turn"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda a, b: _searched(a, b, turn, k), ddl)
    return _top(pairs, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose vec_id is divisible by 50."""
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
