"""Data-quality reports: duplicates, NULLs, quantiles and correlations.

Every report is returned as a DataFrame and built from aggregations with
map-side partial aggregation (plus, for exact quantiles, the distributed
index); no rows are collected to the driver, only one-row results such as
column means or a group total.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_null
from ..plans.sizing import bounded_broadcast
from ..session import materialize
from .sequence import ordered_index, running_total


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: ``total_rows``, ``distinct_rows`` (distinct keys, or distinct
    full rows when ``keys`` is None) and ``duplicate_rows`` = the difference.

    Counts per key first (partial aggregation), then sums the counts."""
    group = list(keys) if keys else df.columns
    per_key = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_cf_copies"))
    return per_key.agg(
        F.sum("_cf_copies").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
        (F.sum("_cf_copies") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, prefix: str = "nulls_") -> DataFrame:
    """One row: ``n_rows`` and, per column, how many values are NULL."""
    cols = list(columns) if columns else df.columns
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in cols],
    )


def rows_with_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with at least one NULL among ``columns`` (default: all)."""
    return df.where(any_null(list(columns) if columns else df.columns))


def quantile(
    df: DataFrame,
    column: str,
    q: float = 0.5,
    rel_err: float = 0.0,
    partition_by: Sequence[str] = (),
    alias: str | None = None,
) -> DataFrame:
    """The ``q`` quantile of ``column`` (per ``partition_by`` group).

    ``rel_err == 0`` is exact and discrete: the value at 1-based position
    ``ceil(q * n)``, 1 at least, in ascending order, NULLs and NaNs left out.
    Copies of a value are counted first (map-side partial aggregation, so a
    price repeated in a third of all rows becomes one row per task), the
    distinct values are ranked with :func:`ordered_index` and their counts
    summed in order with :func:`running_total`; the answer is the value
    whose running count first reaches the position.  No group is held in
    one task.  ``rel_err > 0`` uses ``percentile_approx`` with accuracy
    ``1 / rel_err``, a bounded sketch per group.
    """
    name = alias or f"q_{column}"
    parts = list(partition_by)
    values = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    if rel_err > 0:
        accuracy = max(1, int(round(1.0 / rel_err)))
        agg = F.percentile_approx(F.col(column), float(q), accuracy).alias(name)
        return values.groupBy(*parts).agg(agg) if parts else values.agg(agg)
    counts = values.groupBy(*parts, column).agg(F.count(F.lit(1)).alias("_cf_copies"))
    ranked = ordered_index(counts, [column], parts, "_cf_rank")
    cum = running_total(ranked, parts, "_cf_rank", "_cf_copies", "_cf_upto")
    totals = counts.groupBy(*parts).agg(F.sum("_cf_copies").alias("_cf_n"))
    if parts:
        sizes = bounded_broadcast(
            totals.select(*[F.col(c).alias(f"_cf_g{i}") for i, c in enumerate(parts)], "_cf_n")
        )
        cond = None
        for i, c in enumerate(parts):
            term = cum[c].eqNullSafe(sizes[f"_cf_g{i}"])
            cond = term if cond is None else cond & term
        with_n = cum.join(sizes, cond, "inner").select(*[cum[c] for c in cum.columns], sizes["_cf_n"])
    else:
        total = totals.first()
        with_n = cum.select("*", F.lit(int(total["_cf_n"]) if total and total["_cf_n"] else 0).alias("_cf_n"))
    # The slack keeps a product such as 0.1 * 10 from being taken past its whole number.
    target = F.greatest(F.ceil(F.col("_cf_n").cast("double") * F.lit(float(q)) - F.lit(1e-9)).cast("bigint"), F.lit(1).cast("bigint"))
    hit = (F.col("_cf_upto") - F.col("_cf_copies") < target) & (F.col("_cf_upto") >= target)
    return with_n.where(hit).select(*parts, F.col(column).alias(name))


# Fields per aggregation pass.  Whole-stage codegen is switched off above
# spark.sql.codegen.maxFields (100 by default), which makes a wide
# aggregation many times slower, so wide reports are split into passes.
MAX_AGG_FIELDS = 90


def _pair_chunks(k: int, max_fields: int) -> list[list[tuple[int, int]]]:
    """Group the pairs (i, j), i < j, so that one pass needs at most
    ``max_fields`` sums: n, sum(u) and sum(u*u) per column used, and
    sum(u_i*u_j) per pair."""
    chunks: list[list[tuple[int, int]]] = []
    current: list[tuple[int, int]] = []
    used: set[int] = set()
    for i in range(k):
        for j in range(i + 1, k):
            grown = used | {i, j}
            if current and 1 + 2 * len(grown) + len(current) + 1 > max_fields:
                chunks.append(current)
                current, grown = [], {i, j}
            current.append((i, j))
            used = grown
    if current:
        chunks.append(current)
    return chunks


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def correlation(
    df: DataFrame,
    columns: Sequence[str],
    digits: int | None = None,
    max_fields: int = MAX_AGG_FIELDS,
) -> DataFrame:
    """Pearson correlation of every pair ``a < b`` of ``columns`` (in the
    given order), as a long table ``(col_a, col_b, corr)``.

    Rows with a NULL or NaN in any of the columns are left out (listwise,
    as ``dropna`` before a correlation matrix).  Whole table, no sample, no
    collect of rows.  One pass takes the column means (a one-row result);
    each further pass sums the mean-centred values ``u``: ``n``,
    ``sum(u)``, ``sum(u*u)`` and ``sum(u_i*u_j)``, from which
    ``corr = (S_ij - S_i S_j / n) / sqrt((Q_i - S_i^2/n)(Q_j - S_j^2/n))``.
    Centring keeps the sums free of cancellation, and the pairs are split
    into passes of at most ``max_fields`` sums so every pass stays in
    generated code.  The input is written once to the checkpoint folder so
    the passes read only these columns.  The passes are one SQL statement
    (a ``UNION ALL`` of per-pass aggregations unpivoted with ``stack``).
    """
    cols = list(columns)
    k = len(cols)
    xs = [f"_cf_x{i}" for i in range(k)]
    values = df.select(*[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)])
    values = values.where(~any_null(xs, nan_is_null=True))
    data = materialize(values, "corr")
    means = data.agg(*[F.avg(x).alias(x) for x in xs]).first()
    centre = [float(means[x]) if means[x] is not None and math.isfinite(means[x]) else 0.0 for x in xs]

    def value(i: int, j: int) -> str:
        cov = f"p{i}_{j} - s{i} * s{j} / n"
        var_i = f"q{i} - s{i} * s{i} / n"
        var_j = f"q{j} - s{j} * s{j} / n"
        ratio = f"try_divide({cov}, sqrt(({var_i}) * ({var_j})))"
        # An infinite value leaves no correlation: NULL, not NaN.
        expr = f"nullif(nanvl({ratio}, double('infinity')), double('infinity'))"
        return f"round({expr}, {int(digits)})" if digits is not None else expr

    passes = []
    for chunk in _pair_chunks(k, max_fields):
        idx = sorted({i for pair in chunk for i in pair})
        centred = ", ".join(f"{xs[i]} - {centre[i]!r}D AS u{i}" for i in idx)
        sums = ["CAST(count(1) AS DOUBLE) AS n"]
        sums += [f"sum(u{i}) AS s{i}" for i in idx]
        sums += [f"sum(u{i} * u{i}) AS q{i}" for i in idx]
        sums += [f"sum(u{i} * u{j}) AS p{i}_{j}" for i, j in chunk]
        rows = ", ".join(f"{_sql_text(cols[i])}, {_sql_text(cols[j])}, {value(i, j)}" for i, j in chunk)
        passes.append(
            f"SELECT stack({len(chunk)}, {rows}) AS (col_a, col_b, corr) "
            f"FROM (SELECT {', '.join(sums)} FROM (SELECT {centred} FROM {{data}}))"
        )
    return df.sparkSession.sql(" UNION ALL ".join(passes), data=data)
