"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.session import materialize, table

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; makes this package importable by the Python
    workers of the session first."""
    importable(spark)
    return table(spark, sf_dir, name)


def importable(spark: SparkSession) -> None:
    """Put the repository on the Python path sent along with every Python
    function, so workers find this package wherever the driver started."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each computed once a row: the optimiser does
    not copy what a generator makes into the expressions that use it, which
    inside of array functions would be evaluated for every element."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the values of ``column`` in one slice hold
    about ``limit`` bytes (a single longer value makes a slice of its own)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(ends)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijective scrambling of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(edges: DataFrame, step: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Connected components of ``edges`` (columns a, b; numbers): one row per
    vertex that has an edge: (id, root), root being the smallest id reachable.

    Each round every vertex points to its smallest neighbour (or itself), the
    pointers are followed to their ends, and the edges are rewritten between
    those ends.  At least half of the vertices that still have edges vanish
    per round, so rounds grow with the logarithm of the vertex count.  Every
    intermediate is a written table; nothing but row counts reaches the
    driver, and the joins carry two numbers per row.
    """
    step = step or (lambda df: materialize(df, "cc"))
    edges = step(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = step(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")))
        while True:  # follow pointers until each ends at a vertex that points to itself
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("next"))
            jumped = step(parent.join(up, "root").select("id", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("moved")))
            parent = jumped.select("id", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("next"))
            labels = step(labels.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
        ends_a = parent.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        ends_b = parent.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        edges = step(
            edges.join(ends_a, "a").join(ends_b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
