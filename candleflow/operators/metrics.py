"""Regression metrics in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas


def regression_metrics(
    predictions: DataFrame,
    label_col: str = schemas.LABEL,
    prediction_col: str = "prediction",
    model: str = "model",
    partition_by: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """RMSE, MAE and R² as a long table ``(model, metric, value)`` (plus
    ``partition_by`` columns).

    One aggregation gives all three (the evaluator makes a pass per metric):
    ``rmse = sqrt(avg(e^2))``, ``mae = avg(|e|)``,
    ``r2 = 1 - sum(e^2) / (var_pop(y) * n)``; ``var_pop`` is Spark's
    numerically stable running variance.  Rows with a NULL label or
    prediction are left out.
    """
    y = F.col(label_col).cast("double")
    e = F.col(prediction_col).cast("double") - y
    rows = predictions.where(F.col(label_col).isNotNull() & F.col(prediction_col).isNotNull())
    aggs = [
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
    ]
    parts = list(partition_by)
    wide = rows.groupBy(*parts).agg(*aggs) if parts else rows.agg(*aggs)
    r = (lambda c: F.round(F.col(c), digits)) if digits is not None else F.col
    long = wide.select(
        *parts,
        F.lit(model).alias("model"),
        F.explode(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), r(m).alias("value")) for m in schemas.METRICS]
            )
        ).alias("_cf_m"),
    )
    return long.select(*parts, "model", "_cf_m.metric", "_cf_m.value")
