"""Row-offset features and the ten-rows-ahead label.

Offsets count rows, not minutes: a missing candle stretches the horizon, as
in the reference.  Frames are ROWS frames that are partial at the head of a
series, so the moving averages are never NULL when ``close`` is not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import pct_change, safe_ratio
from .clean import drop_missing
from .sequence import DEFAULT_BLOCK_ROWS, block_window, ordered_index

# Columns kept by ``layout=True``: the row number in the series and the
# block of the feature window.
LAYOUT_ROW = "_cf_series_row"
LAYOUT_BLOCK = "_cf_series_block"
LAYOUT_COLUMNS = (LAYOUT_ROW, LAYOUT_BLOCK)


def add_features(
    silver: DataFrame,
    partition_by: Sequence[str] = (schemas.SYMBOL,),
    time_col: str = schemas.OPEN_TIME,
    index_col: str | None = None,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    total_col: str | None = None,
    layout: bool = False,
    extra: Callable[[WindowSpec], dict[str, Column]] | None = None,
) -> DataFrame:
    """Append ``close_t_plus_10, close_prev, return_1m, ma_5, ma_10,
    taker_ratio`` to silver rows (no rows are dropped here).

    Each series (``partition_by``; empty means the whole table is one
    series) is numbered by :func:`ordered_index` and the four window columns
    are evaluated in blocks by :func:`block_window`, so a long series is
    spread over many tasks.  Divisions are NULL-safe (``try_divide``).
    ``index_col`` keeps the row number inside the series and ``total_col``
    the series length, when given.  ``layout=True`` also keeps the block
    columns (:data:`LAYOUT_COLUMNS`) so :func:`split.chrono_split` can number
    rows without another sort.  ``extra`` builds more columns over the same
    windows (frames of at most 9 rows back and 10 ahead).
    """
    parts = list(partition_by)
    idx_name = index_col or (LAYOUT_ROW if layout else "_cf_row")
    indexed = ordered_index(silver, [time_col], parts, index_col=idx_name, total_col=total_col)

    def window_columns(w):
        return {
            "close_t_plus_10": F.lead("close", schemas.LABEL_LEAD_ROWS).over(w),
            "close_prev": F.lag("close", schemas.PREV_LAG_ROWS).over(w),
            "ma_5": F.avg("close").over(w.rowsBetween(-(schemas.MA_SHORT_ROWS - 1), 0)),
            "ma_10": F.avg("close").over(w.rowsBetween(-(schemas.MA_LONG_ROWS - 1), 0)),
            **(extra(w) if extra else {}),
        }

    reach_back = max(schemas.PREV_LAG_ROWS, schemas.MA_LONG_ROWS - 1)
    windowed = block_window(
        indexed,
        parts,
        idx_name,
        window_columns,
        behind=reach_back,
        ahead=schemas.LABEL_LEAD_ROWS,
        block_rows=block_rows,
        block_col=LAYOUT_BLOCK if layout else None,
    )
    out = [F.col(c) for c in silver.columns]
    out += [
        F.col("close_t_plus_10"),
        F.col("close_prev"),
        pct_change("close", "close_prev").alias("return_1m"),
        F.col("ma_5"),
        F.col("ma_10"),
        safe_ratio("taker_buy_base_volume", "volume").alias("taker_ratio"),
    ]
    if extra:
        out += [F.col(c) for c in windowed.columns if c not in (*silver.columns, *schemas.DERIVED_COLUMNS, idx_name, total_col, *LAYOUT_COLUMNS)]
    if index_col:
        out.append(F.col(index_col))
    if total_col:
        out.append(F.col(total_col))
    if layout:
        out += [F.col(c) for c in (LAYOUT_ROW, LAYOUT_BLOCK) if c != index_col]
    return windowed.select(*out)


def features(
    silver: DataFrame,
    null_policy: str | Sequence[str] | None = schemas.DEFAULT_NULL_POLICY,
    partition_by: Sequence[str] = (schemas.SYMBOL,),
    block_rows: int = DEFAULT_BLOCK_ROWS,
    layout: bool = False,
) -> DataFrame:
    """Silver to the feature table: :func:`add_features` then the null
    policy (default: label and return must be present).  The policy looks
    at the feature columns only, also when ``layout`` keeps the block
    columns."""
    feats = add_features(silver, partition_by, block_rows=block_rows, layout=layout)
    if layout and (null_policy is None or null_policy == "all"):
        null_policy = [c for c in feats.columns if c not in LAYOUT_COLUMNS]
    return drop_missing(feats, null_policy)
