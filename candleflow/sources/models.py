"""Saved model source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegressionModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import SparkSession

from .. import schemas
from ..session import path_exists


class DamagedModelError(RuntimeError):
    """There is something at the path, but no model that loads."""


class ModelInputsError(RuntimeError):
    """A saved model was fitted on other inputs than the caller feeds it."""


def model_inputs(model: Transformer) -> list[str] | None:
    """The input columns of a model, in order: those that its first stages
    read and no earlier stage makes; None for a bare model, which takes an
    assembled vector."""
    if not isinstance(model, PipelineModel):
        return None
    read: list[str] = []
    made: set[str] = set()
    for stage in model.stages:
        if isinstance(stage, VectorAssembler) or stage.hasParam("inputCols") and stage.isSet("inputCols"):
            read += [c for c in stage.getInputCols() if c not in made and c not in read]
            made |= set(stage.getOutputCols() if stage.hasParam("outputCols") and stage.isSet("outputCols") else [stage.getOutputCol()])
    return read


def load_model(path: str, inputs: Sequence[str] | None = schemas.MODEL_INPUTS) -> Transformer | None:
    """Load a saved model: a ``PipelineModel``, or a bare
    ``LinearRegressionModel``.

    Returns ``None`` when there is nothing at ``path`` (scoring with ``None``
    is an error).  What is there but doesn't load raises
    :class:`DamagedModelError`, a model of other inputs than ``inputs``, in
    names, order or (for a bare model) number, :class:`ModelInputsError`;
    ``inputs=None`` takes any."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    if not path_exists(spark, path):
        return None
    try:
        kind = DefaultParamsReader.loadMetadata(path, spark)["class"].rpartition(".")[2]
        model = (PipelineModel if kind == "PipelineModel" else LinearRegressionModel).load(path)
    except Exception as e:
        raise DamagedModelError(f"no model loads from {path}: {str(e).splitlines()[0][:300]}") from e
    if inputs is not None:
        own = model_inputs(model)
        if own is not None and own != list(inputs):
            raise ModelInputsError(f"the model at {path} reads {own}, not {list(inputs)}")
        if own is None and model.numFeatures != len(inputs):
            raise ModelInputsError(f"the model at {path} takes {model.numFeatures} inputs, not {len(inputs)}")
    return model
