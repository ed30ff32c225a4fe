"""Vectors in tables: which take part, and their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """One row per vector that takes part: vec_id, v (its components as
    little-endian doubles' source array); and the dimension.

    Vectors that are null, hold a null or non-finite component or are zero
    take no part, nor do null vec_ids.  The dimension is the most frequent
    length, the smaller at a tie; vectors of other lengths take no part.  Rows
    that repeat a vec_id are one vector, the smallest by components.
    """
    x = F.col(column)
    fine = rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
                      & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                      & F.exists(x, lambda c: c != 0))
    fine = fine.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(x.cast("array<double>")).alias("v"))
    lengths = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dim = lengths[0]["n"] if lengths else 0
    return fine.where(F.size("v") == dim), dim


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
