"""Quantiles from stored, mergeable KLL sketches.

A sketch is a few kilobytes whatever the number of values behind it.  One per
group and day is stored when the day is written; quantiles of any span of days
and any coarser grouping come from merging stored sketches, without the rows.
Spark's own sketch aggregates build and merge them: tasks sketch their share
before the shuffle, so a symbol that holds a third of all rows moves one
sketch per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sinks.writers import write_parquet

#: Size parameter of the sketches; the rank error falls with it.
K = 800
DAY = "sketch_day"


def rank_error(k: int = K) -> float:
    """The rank error, as a share of the values, that a sketch of parameter
    ``k`` keeps to with a probability of 99 % per question (the published fit
    for KLL sketches)."""
    return 2.296 / k**0.9021


def sketch_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row per group of ``by`` and column: (by..., column_name, sketch).
    NULL and NaN are left out; a group without values has an empty sketch."""
    values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns]
    aggs = [F.kll_sketch_agg_double(v, k).alias(f"_cf_k{i}") for i, v in enumerate(values)]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_cf_k{i}").alias("sketch")) for i, c in enumerate(columns)]
    return wide.select(*by, F.inline(F.array(*entries)))


def store_sketches(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    by: Sequence[str] = (schemas.SYMBOL,),
    time_col: str = schemas.OPEN_TIME,
    k: int = K,
) -> None:
    """Write a sketch per group of ``by``, column and day of ``time_col``, in a
    folder per day.  Days that ``df`` holds replace what is stored of them, so
    ``df`` has whole days; other days stay.  Writing a day again therefore
    counts nothing twice."""
    dated = df.withColumn(DAY, F.to_date(F.col(time_col)))
    write_parquet(sketch_columns(dated, columns, [*by, DAY], k), path, partition_by=[DAY])


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The stored sketches; a filter on ``sketch_day`` reads those days only."""
    return spark.read.parquet(path)


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One sketch per group of ``by`` and column, merged within tasks first."""
    return sketches.groupBy(*by, "column_name").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, q, n, value): per sketch and ``q`` the value whose
    rank is about ``q * n`` (see :func:`rank_error`); NULL without values."""
    counted = sketches.select(*by, "column_name", "sketch", F.kll_sketch_get_n_double("sketch").alias("n"))
    answers = [
        F.struct(F.lit(float(q)).alias("q"), F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias("value"))
        for q in qs]
    return counted.select(*by, "column_name", "n", F.inline(F.array(*answers))).select(*by, "column_name", "q", "n", "value")


def quantile_rank_errors(df: DataFrame, answers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``answers`` (of :func:`sketch_quantiles`, over one column that ``df``
    holds under its name) with ``off``: how far, as a share of the values, the
    rank asked for lies from the ranks that equal values take up in ``df``.

    The rows meet the answers of their group, a handful per group, in one
    pass; they are counted within tasks before the shuffle."""
    name = answers.select("column_name").first()
    if name is None:
        return answers.withColumn("off", F.lit(None).cast("double"))
    # The group's answers travel as one array, so the join is one row a group.
    grouped = answers.groupBy(*by).agg(F.collect_list(F.struct("q", "n", "value")).alias("_cf_asked"))
    x = F.nanvl(F.col(f"`{name[0]}`").cast("double"), F.lit(None).cast("double"))
    rows = df.select(*by, x.alias("_cf_x")).where("_cf_x is not null")
    counts = rows.groupBy(*by, "_cf_x").agg(F.count(F.lit(1)).alias("_cf_copies"))
    if by:
        joined = counts.join(grouped, list(by))
    else:  # one row of answers: literals
        asked = grouped.first()["_cf_asked"]
        joined = counts.withColumn("_cf_asked", F.array(*[
            F.struct(F.lit(a.q).alias("q"), F.lit(a.n).alias("n"), F.lit(a.value).alias("value")) for a in asked]))
    each = joined.select(*by, "_cf_x", "_cf_copies", F.inline("_cf_asked"))
    ranks = each.groupBy(*by, "q", "n", "value").agg(
        F.sum(F.when(F.col("_cf_x") < F.col("value"), F.col("_cf_copies")).otherwise(0)).alias("_cf_below"),
        F.sum(F.when(F.col("_cf_x") <= F.col("value"), F.col("_cf_copies")).otherwise(0)).alias("_cf_upto"),
    )
    target = F.col("q") * F.col("n")
    gap = F.greatest(F.col("_cf_below") - target, target - F.col("_cf_upto"), F.lit(0.0))
    return ranks.select(*by, F.lit(name[0]).alias("column_name"), "q", "n", "value", (gap / F.col("n")).alias("off"))
