"""Scoring feature rows with a fitted or saved model, and shaping the
prediction records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import as_instant, linear_combination
from .ml import assembler


def _with_invalid_policy(model: PipelineModel, handle_invalid: str) -> PipelineModel:
    """A copy of ``model`` whose bins and vector assembler use ``handle_invalid``."""
    stages = [
        s.copy({s.handleInvalid: handle_invalid}) if isinstance(s, (Bucketizer, VectorAssembler)) else s for s in model.stages
    ]
    return PipelineModel(stages)


def score(
    df: DataFrame,
    model: Transformer | None,
    inputs: Sequence[str] = schemas.MODEL_INPUTS,
    prediction_col: str = "prediction",
    keep: Sequence[str] | None = None,
    handle_invalid: str = "error",
) -> DataFrame:
    """Add ``prediction_col`` to every row of ``df`` (a table or a stream).

    A ``PipelineModel`` assembles its own vector; a bare regression model is
    given the assembled inputs first.  Inputs stay DOUBLE (no FLOAT
    rounding).  A missing input column or a missing model is an error.
    ``keep`` limits the output to those columns plus the prediction.

    A row with a NULL/NaN input raises (``handle_invalid="error"``);
    ``"keep"`` keeps every row (NaN prediction) and ``"skip"`` drops such
    rows.
    """
    if model is None:
        raise RuntimeError("no model is loaded")
    missing = [c for c in inputs if c not in df.columns]
    if missing:
        raise ValueError(f"input columns missing: {missing}")
    if isinstance(model, PipelineModel):
        scored = _with_invalid_policy(model, handle_invalid).transform(df)
    else:
        scored = model.transform(assembler(inputs, handle_invalid=handle_invalid).transform(df))
    if prediction_col not in scored.columns:
        if "prediction" in scored.columns:
            scored = scored.withColumnRenamed("prediction", prediction_col)
        else:
            raise ValueError("the model output has no prediction column")
    cols = list(keep) if keep is not None else [c for c in df.columns]
    return scored.select(*cols, prediction_col)


def score_linear(
    df: DataFrame,
    coefficients: dict[str, float] | Sequence[float],
    intercept: float,
    inputs: Sequence[str] = schemas.MODEL_INPUTS,
    prediction_col: str = "prediction",
) -> DataFrame:
    """Score with known linear coefficients as a plain column expression
    (``intercept + sum(w_i * x_i)``), evaluated in generated code."""
    if not isinstance(coefficients, dict):
        coefficients = dict(zip(inputs, coefficients, strict=True))
    missing = [c for c in coefficients if c not in df.columns]
    if missing:
        raise ValueError(f"input columns missing: {missing}")
    return df.select("*", linear_combination(coefficients, intercept).alias(prediction_col))


def to_predictions(
    scored: DataFrame,
    time_col: str = schemas.OPEN_TIME,
    prediction_col: str = "prediction",
    key_cols: Sequence[str] = (schemas.SYMBOL,),
) -> DataFrame:
    """Prediction records ``(id, market_time, predicted_price, created_at)``.

    ``id`` is a 128-bit digest of the series key and the market time as given
    (a sequential database id is not reproducible in parallel); ``created_at``
    is the time of the scoring query; a NULL market time becomes that time.
    A TIMESTAMP_NTZ market time is read as UTC.
    """
    keys = [F.col(k) for k in key_cols if k in scored.columns]
    market_time = F.coalesce(as_instant(scored, time_col), F.current_timestamp())
    return scored.select(
        F.md5(F.to_json(F.struct(*keys, F.col(time_col)), {"ignoreNullFields": "false"})).alias("id"),
        *[F.col(k) for k in key_cols if k in scored.columns],
        market_time.alias("market_time"),
        F.col(prediction_col).cast("double").alias("predicted_price"),
        F.current_timestamp().alias("created_at"),
    )
