"""Cleaning: keyed and full-row de-duplication, null policies, silver, and
the most recent rows per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import any_null, hash_unit


def dedup_keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    keep: str = "first",
    complete_first: bool = False,
) -> DataFrame:
    """Keep one row per key: the first in ``order_by`` order (``keep="last"``
    for the last one).

    Ties in ``order_by`` are broken by the remaining columns, so the result
    is the same on every run.  NULLs order first, as in Spark's ascending
    sort.  With ``complete_first`` a row without NULLs beats any row with
    one, so a complete duplicate is never lost to an incomplete one.

    This is an aggregation, not a window: each task keeps only its best row
    per key before the shuffle (partial aggregation), so a key that holds a
    third of all rows costs one row per task, not one task for all of them.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by or [])
    tail = [c for c in rest if c not in order]
    fields = []
    if complete_first:
        flag = ~any_null(rest) if keep == "last" else any_null(rest)
        fields.append(flag.alias("_cf_incomplete"))
    fields += [F.col(c).alias(f"_cf_o{i}") for i, c in enumerate(order)]
    fields += [F.col(c) for c in tail]
    if not fields:
        return df.dropDuplicates(keys)
    best = F.max if keep == "last" else F.min
    picked = df.groupBy(*keys).agg(best(F.struct(*fields)).alias("_cf_row"))
    out = []
    for c in df.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in order:
            out.append(F.col(f"_cf_row._cf_o{order.index(c)}").alias(c))
        else:
            out.append(F.col(f"_cf_row.{c}").alias(c))
    return picked.select(*out)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (hash aggregation with partial aggregation)."""
    return df.dropDuplicates()


def drop_missing(df: DataFrame, policy: str | Sequence[str] | None = schemas.DEFAULT_NULL_POLICY) -> DataFrame:
    """Drop rows with a NULL or NaN in the columns of a null policy.

    ``policy`` is a policy name from :data:`schemas.NULL_POLICIES`, an
    explicit list of columns, or ``None``/``"all"`` for every column.
    """
    if isinstance(policy, str):
        if policy not in schemas.NULL_POLICIES:
            raise ValueError(f"unknown null policy {policy!r}")
        subset = schemas.NULL_POLICIES[policy]
    else:
        subset = policy
    return df.dropna(how="any", subset=list(subset) if subset else None)


def present(df: DataFrame, policy: str | Sequence[str] | None) -> Column:
    """Whether a row of ``df`` passes a null policy (see :func:`drop_missing`)."""
    subset = schemas.NULL_POLICIES[policy] if isinstance(policy, str) else policy
    names = list(subset) if subset else df.columns
    floats = [c for c in names if df.schema[c].dataType.typeName() in ("float", "double")]
    return ~any_null(names) & ~any_null(floats, nan_is_null=True)


def newest_candles(
    df: DataFrame,
    keys: Sequence[str] = (schemas.SYMBOL, schemas.OPEN_TIME),
    poll_col: str | None = None,
    complete_first: bool = True,
) -> DataFrame:
    """One row per candle: the copy of the newest poll.

    ``poll_col`` is the poll's time or number where the table has one.  A
    candle's trade count only grows while it is open, so among copies of one
    poll, or without a poll column, the one with more trades is newer.
    Complete copies beat incomplete ones; what is left of a tie is broken by
    the other columns, so the result is the same on every run.
    """
    order = [c for c in (poll_col, "number_of_trades") if c and c in df.columns]
    return dedup_keep_first(df, [k for k in keys if k in df.columns], order, keep="last", complete_first=complete_first)


def to_silver(
    bronze: DataFrame,
    keys: Sequence[str] = (schemas.SYMBOL, schemas.OPEN_TIME),
    complete_first: bool = True,
    poll_col: str | None = None,
) -> DataFrame:
    """Bronze to silver: the newest copy of each (symbol, open_time), see
    :func:`newest_candles`, then drop rows with any NULL/NaN.  The ``ignore``
    column has no consumer and is dropped, and so is ``poll_col``.

    ``complete_first=False`` lets an incomplete newest copy win, which then
    loses its key.
    """
    df = bronze.drop("ignore") if "ignore" in bronze.columns else bronze
    deduped = newest_candles(df, keys, poll_col, complete_first)
    return (deduped.drop(poll_col) if poll_col else deduped).dropna(how="any")


def latest_n(
    df: DataFrame,
    n: int,
    partition_by: Sequence[str] = (schemas.SYMBOL,),
    order_by: str = schemas.OPEN_TIME,
    salt_buckets: int = 256,
) -> DataFrame:
    """The ``n`` most recent rows of each series (top-k per key).

    ``row_number() <= n`` lets Spark cut every task to its own top ``n`` per
    key before the shuffle (partial WindowGroupLimit).  Two rounds keep a
    hot key from funnelling the survivors of every input task into one
    task: the salt of the first round is the input task number modulo
    ``salt_buckets``, so the map side still keeps just ``n`` rows per key and
    task, and each first-round group merges the survivors of only a share of
    the tasks; the second round sees at most ``salt_buckets * n`` rows per
    key.  Ties in ``order_by`` are broken by a hash of the row's columns.
    """
    parts = list(partition_by)
    if n <= 0:
        return df.limit(0)
    salt = F.pmod(F.spark_partition_id(), F.lit(salt_buckets))
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    ordered = [F.col(order_by).desc_nulls_last(), F.col("_cf_tie").desc()]
    first = (
        df.select("*", salt.alias("_cf_salt"), tie.alias("_cf_tie"))
        .withColumn("_cf_rn", F.row_number().over(Window.partitionBy(*parts, "_cf_salt").orderBy(*ordered)))
        .where(F.col("_cf_rn") <= F.lit(n))
    )
    second = first.withColumn(
        "_cf_rn", F.row_number().over(Window.partitionBy(*parts).orderBy(*ordered))
    ).where(F.col("_cf_rn") <= F.lit(n))
    return second.drop("_cf_salt", "_cf_tie", "_cf_rn")


def sample_rows(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Bernoulli sample that keeps a row when a hash of its keys falls under
    ``fraction``.  The same rows are kept however the data is partitioned,
    which ``DataFrame.sample`` does not guarantee."""
    return df.where(hash_unit(keys, seed) < F.lit(float(fraction)))
