"""Time order index and the chronological train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import train_cutoff
from .features import LAYOUT_BLOCK, LAYOUT_COLUMNS, LAYOUT_ROW
from .sequence import ordered_index


def time_index(
    df: DataFrame,
    time_col: str = schemas.OPEN_TIME,
    tie_break: Sequence[str] = (schemas.SYMBOL,),
    partition_by: Sequence[str] = (),
    index_col: str = "row_id",
) -> DataFrame:
    """``row_number()`` in time order, over the whole table by default
    (``partition_by`` numbers each series separately).  ``tie_break`` orders
    rows with the same time.  Runs as a distributed index, never as a
    single-task global window."""
    order = [time_col, *[c for c in tie_break if c not in partition_by]]
    return ordered_index(df, order, list(partition_by), index_col=index_col)


def chrono_split(
    df: DataFrame,
    partition_by: Sequence[str] = (schemas.SYMBOL,),
    time_col: str = schemas.OPEN_TIME,
    numerator: int = schemas.TRAIN_NUMERATOR,
    denominator: int = schemas.TRAIN_DENOMINATOR,
    purge: int = 0,
    index_col: str = "row_id",
    split_col: str = "split",
) -> DataFrame:
    """Label each row ``train`` or ``test``: within each series the first
    ``floor(n * numerator / denominator)`` rows in time order train, the rest
    test.  ``purge`` drops that many training rows in front of the cut,
    whose ten-rows-ahead labels would otherwise lie in the test period.
    Adds ``index_col`` (row number in the series) and ``split_col``.

    On a feature table built with ``layout=True`` (same plan) the rows are
    numbered inside the blocks of the feature window, which the data is
    still partitioned and sorted by, plus per-block offsets (see
    :func:`_index_from_layout`); otherwise a new distributed index is
    built."""
    parts = list(partition_by)
    layout = set(LAYOUT_COLUMNS) <= set(df.columns)
    if layout and time_col == schemas.OPEN_TIME:
        indexed = _index_from_layout(df, parts, index_col)
        cols = [c for c in df.columns if c not in LAYOUT_COLUMNS]
    else:
        indexed = ordered_index(df, [time_col], parts, index_col=index_col, total_col="_cf_n")
        cols = list(df.columns)
    cut = train_cutoff("_cf_n", numerator, denominator)
    label = (
        F.when(F.col(index_col) <= cut - F.lit(int(purge)), F.lit("train"))
        .when(F.col(index_col) > cut, F.lit("test"))
        .otherwise(F.lit("purged"))
    )
    out = indexed.select(*cols, index_col, label.alias(split_col))
    if purge:
        out = out.where(F.col(split_col) != F.lit("purged"))
    return out


def _index_from_layout(df: DataFrame, parts: list[str], index_col: str) -> DataFrame:
    """Row number (in series-row order) of the rows left in a layout-carrying
    feature table, plus the series length ``_cf_n``.

    The feature window left the rows hash-partitioned by (series, block) and
    sorted by the series row, so the per-block row number needs no shuffle,
    and the equi-join on (series, block) with the small table of block
    offsets keeps the big side where it is.  The per-block counts re-run the
    feature window on just the columns they need (keys, series row and the
    columns the null policy reads): a narrow shuffle instead of a second
    full-width sort and write.  Series keys must not be NULL (silver
    guarantees it)."""
    keys = [*parts, LAYOUT_BLOCK]
    in_block = Window.partitionBy(*keys).orderBy(LAYOUT_ROW)
    local = df.select("*", F.row_number().over(in_block).alias("_cf_local"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cf_cnt"))
    series = Window.partitionBy(*parts) if parts else Window.partitionBy()
    before = series.orderBy(LAYOUT_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        F.coalesce(F.sum("_cf_cnt").over(before), F.lit(0)).alias("_cf_before"),
        F.sum("_cf_cnt").over(series).alias("_cf_n"),
    )
    joined = local.join(offsets, keys, "inner")
    return joined.select(
        *[c for c in df.columns],
        (F.col("_cf_before") + F.col("_cf_local")).alias(index_col),
        "_cf_n",
    )


def train_test(split: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    """The two halves of :func:`chrono_split` output."""
    return (
        split.where(F.col(split_col) == F.lit("train")),
        split.where(F.col(split_col) == F.lit("test")),
    )
