"""Row offsets over long series without putting a series in one task.

``Window.partitionBy(symbol).orderBy(open_time)`` sends every row of a
symbol to one task, and ``Window.orderBy(open_time)`` sends the whole table
to one task.  When one symbol holds a third of all rows that task is the
job.  Two operators here avoid it:

* :func:`ordered_index` gives every row its ``row_number()`` inside its
  series (or over the whole table) with a range shuffle, a per-task count
  and a broadcast of the tiny table of per-task offsets.
* :func:`block_window` evaluates row-offset window functions (lead, lag,
  trailing ROWS frames) inside fixed-size blocks of that index.  Each block
  gets a copy of the few neighbouring rows its frames reach into, so the
  result equals the unpartitioned window while no task sees more than one
  block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, col
from ..plans.sizing import bounded_broadcast
from ..session import materialize

# Rows per block of :func:`block_window`.  A block is one window partition
# (sorted in one task), and the halo copied into it is at most the frame
# reach, so 20 extra rows per 100,000 is a 0.02 % overhead.
DEFAULT_BLOCK_ROWS = 100_000

_PART = "_cf_part"
_TIE = "_cf_tie"
_POS = "_cf_pos"
_SHIFT = "_cf_shift"
_TOTAL = "_cf_total"
_HOME = "_cf_home"
_BLOCK = "_cf_block"


def _names(cols: Sequence[ColumnOrName]) -> list[str]:
    out = []
    for c in cols:
        if not isinstance(c, str):
            raise TypeError("partition columns must be given by name")
        out.append(c)
    return out


def ordered_index(
    df: DataFrame,
    order_by: Sequence[ColumnOrName],
    partition_by: Sequence[str] = (),
    index_col: str = "row_id",
    total_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``index_col`` = ``row_number() over (partition by partition_by
    order by order_by)`` (1-based), and optionally ``total_col`` = rows in
    the row's partition.

    Plan: range shuffle on (partition_by, order_by) so that every task holds
    one contiguous slice of the order, sort inside each task, tag each row
    with its task and its position, write that to the shared checkpoint
    folder (so the tags never change on a recompute), count rows per
    (task, partition key), turn the counts into offsets with a window over
    that small table, and broadcast the offsets back.  A hot key simply
    spans many tasks, and so does a run of equal ``order_by`` values unless
    the rows are exact copies (count copies first, as :func:`quantile`
    does).  Ties in ``order_by`` are numbered in an arbitrary order that is
    fixed once written; give a unique order for reproducible numbers.
    """
    parts = _names(partition_by)
    # A hash of the whole row breaks ties, so a run of equal keys is split
    # over tasks like any other range as long as the rows differ somewhere.
    # It is a function of the row alone, so a re-run task sends every row to
    # the same range as before.
    spread = df.select("*", F.xxhash64(*[F.col(c) for c in df.columns]).alias(_TIE))
    keys = [col(c) for c in parts] + [col(c) for c in order_by] + [F.col(_TIE)]
    if num_partitions:
        ranged = spread.repartitionByRange(num_partitions, *keys)
    else:
        ranged = spread.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).select(
        *[F.col(c) for c in df.columns],
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().alias(_POS),
    )
    tagged = materialize(ranged, "index")

    runs = tagged.groupBy(_PART, *parts).agg(
        F.count(F.lit(1)).alias("_cf_n"),
        F.min(_POS).alias("_cf_first"),
    )
    by_key = Window.partitionBy(*parts) if parts else Window.partitionBy()
    before = by_key.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    run_cols = [F.col(_PART).alias("_cf_run_part")]
    run_cols += [F.col(c).alias(f"_cf_run_{i}") for i, c in enumerate(parts)]
    run_cols.append((F.coalesce(F.sum("_cf_n").over(before), F.lit(0)) - F.col("_cf_first")).alias(_SHIFT))
    if total_col:
        run_cols.append(F.sum("_cf_n").over(by_key).alias(_TOTAL))
    offsets = bounded_broadcast(runs.select(*run_cols))

    cond = tagged[_PART] == offsets["_cf_run_part"]
    for i, c in enumerate(parts):
        cond = cond & tagged[c].eqNullSafe(offsets[f"_cf_run_{i}"])
    joined = tagged.join(offsets, cond, "inner")
    out_cols = [tagged[c] for c in df.columns]
    out_cols.append((tagged[_POS] + offsets[_SHIFT] + F.lit(1)).alias(index_col))
    if total_col:
        out_cols.append(offsets[_TOTAL].alias(total_col))
    return joined.select(*out_cols)


def block_window(
    indexed: DataFrame,
    partition_by: Sequence[str],
    index_col: str,
    columns: Callable[[WindowSpec], dict[str, Column]],
    behind: int,
    ahead: int,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    block_col: str | None = None,
) -> DataFrame:
    """Evaluate row-offset window columns in blocks of ``block_rows`` rows.

    ``columns(w)`` builds the new columns from ``w``, a window partitioned by
    (partition_by, block) and ordered by ``index_col``; frames may reach at
    most ``behind`` rows back and ``ahead`` rows forward.  Rows within
    ``ahead`` rows of a block's start are copied into the previous block and
    rows within ``behind`` rows of its end into the next one, the window runs
    per block, and only each block's own rows are kept.  ``block_col`` keeps
    the block number: the output is then hash-partitioned by
    (partition_by, block_col) and sorted by ``index_col`` within each block,
    which later per-block work can use without a shuffle.
    """
    parts = _names(partition_by)
    k = int(block_rows)
    if k < max(behind, ahead, 1):
        raise ValueError("block_rows must be at least the frame reach")
    pos0 = F.col(index_col) - F.lit(1)
    offset = F.pmod(pos0, F.lit(k))
    home = ((pos0 - offset) / F.lit(k)).cast("bigint")
    targets = F.array(
        home,
        F.when(offset < F.lit(ahead), home - F.lit(1)),
        F.when(offset >= F.lit(k - behind), home + F.lit(1)),
    )
    spread = (
        indexed.select("*", home.alias(_HOME), F.explode(targets).alias(_BLOCK))
        .where(F.col(_BLOCK).isNotNull())
    )
    w = Window.partitionBy(*parts, _BLOCK).orderBy(index_col)
    new_cols = columns(w)
    computed = spread.select("*", *[c.alias(name) for name, c in new_cols.items()])
    own = computed.where(F.col(_BLOCK) == F.col(_HOME)).drop(_HOME)
    return own.withColumnRenamed(_BLOCK, block_col) if block_col else own.drop(_BLOCK)


def running_total(
    indexed: DataFrame,
    partition_by: Sequence[str],
    index_col: str,
    value_col: str,
    out_col: str,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Add ``out_col`` = ``sum(value_col)`` over all rows of the row's
    partition up to and including it in ``index_col`` order.

    Sums inside blocks of ``block_rows`` rows are a window per block (one
    balanced shuffle); block totals become per-block offsets with a window
    over the small table of blocks, broadcast back after a size check.
    """
    parts = _names(partition_by)
    k = int(block_rows)
    pos0 = F.col(index_col) - F.lit(1)
    block = ((pos0 - F.pmod(pos0, F.lit(k))) / F.lit(k)).cast("bigint")
    blocked = indexed.select("*", block.alias(_BLOCK))
    within = Window.partitionBy(*parts, _BLOCK).orderBy(index_col).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.select("*", F.sum(value_col).over(within).alias("_cf_local"))
    totals = blocked.groupBy(*parts, _BLOCK).agg(F.sum(value_col).alias("_cf_block_sum"))
    earlier = (Window.partitionBy(*parts) if parts else Window.partitionBy()).orderBy(_BLOCK)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_cf_b_{i}") for i, c in enumerate(parts)],
        F.col(_BLOCK).alias("_cf_b_block"),
        F.coalesce(F.sum("_cf_block_sum").over(earlier), F.lit(0)).alias("_cf_before"),
    )
    offsets = bounded_broadcast(offsets)
    cond = local[_BLOCK] == offsets["_cf_b_block"]
    for i, c in enumerate(parts):
        cond = cond & local[c].eqNullSafe(offsets[f"_cf_b_{i}"])
    joined = local.join(offsets, cond, "inner")
    return joined.select(
        *[local[c] for c in indexed.columns],
        (offsets["_cf_before"] + local["_cf_local"]).alias(out_col),
    )
