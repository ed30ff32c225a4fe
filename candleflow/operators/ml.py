"""Spark ML: feature vector, the three regressor families, comparison.

Training always produces a ``PipelineModel`` (assembler + regressor), so a
saved model scores raw feature rows without a separate assembly step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import hash_unit
from .metrics import regression_metrics

FAMILIES = ("lr", "gbt", "rf")
#: Rows of a task in fits of many passes: a pass over them takes about as long as starting the task.
ROWS_PER_TASK = 20_000
#: So many partitions of few rows are not worth a shuffle.
FEW_TASKS = 16


def assembler(
    inputs: Sequence[str] = schemas.MODEL_INPUTS,
    output_col: str = "features",
    handle_invalid: str = "error",
) -> VectorAssembler:
    """Vector of the model inputs in their fixed order.  ``handle_invalid``
    is ``"error"`` (raise on NULL/NaN), ``"skip"`` (drop the row) or
    ``"keep"``."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output_col, handleInvalid=handle_invalid)


def assemble(df: DataFrame, inputs: Sequence[str] = schemas.MODEL_INPUTS, handle_invalid: str = "error") -> DataFrame:
    """Add the ``features`` vector column."""
    return assembler(inputs, handle_invalid=handle_invalid).transform(df)


def estimator(
    family: str,
    label_col: str = schemas.LABEL,
    prediction_col: str = "prediction",
    **params,
):
    """A regressor of one family with the settings of the reference
    comparison; ``params`` override them."""
    common = {"featuresCol": "features", "labelCol": label_col, "predictionCol": prediction_col}
    if family == "lr":
        return LinearRegression(**common, **{**schemas.LR_PARAMS, **params})
    if family == "gbt":
        return GBTRegressor(**common, **{**schemas.GBT_PARAMS, **params})
    if family == "rf":
        return RandomForestRegressor(**common, **{**schemas.RF_PARAMS, **params})
    raise ValueError(f"unknown model family {family!r}")


def fit(
    train: DataFrame,
    family: str = "lr",
    inputs: Sequence[str] = schemas.MODEL_INPUTS,
    label_col: str = schemas.LABEL,
    prediction_col: str = "prediction",
    handle_invalid: str = "skip",
    order_keys: Sequence[str] = (schemas.SYMBOL, schemas.OPEN_TIME),
    **params,
) -> PipelineModel:
    """Fit assembler + regressor on ``train`` (rows with a NULL label are
    left out).  The rows are persisted for the fit's passes, in the partitions
    they come in for the one pass of ``lr``, else in even ones (see
    :func:`evened`).  ``order_keys`` name a row for the forest's bags
    (see :func:`fit_forest`)."""
    rows = prepared(train, inputs, label_col, order_keys)
    if family == "lr":
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return _fit_prepared(rows, family, inputs, label_col, prediction_col, handle_invalid, order_keys, **params)
        finally:
            rows.unpersist()
    with evened(rows) as even:
        return _fit_prepared(even, family, inputs, label_col, prediction_col, handle_invalid, order_keys, **params)


def prepared(train, inputs, label_col, order_keys) -> DataFrame:
    """The labelled rows with what fits read."""
    columns = [c for c in dict.fromkeys([*order_keys, *inputs, label_col]) if c in train.columns]
    return train.where(F.col(label_col).isNotNull()).select(*columns)


@contextmanager
def evened(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK):
    """All of ``rows``, persisted in as many equal partitions as their number
    asks for, for fits that read them in hundreds of small jobs.

    The feature window leaves the rows in a partition for each block of a
    series among ``spark.sql.shuffle.partitions``, most of them empty: every
    job then starts that many tasks while a few hold all rows.  Here the rows
    are dealt by a hash of their columns and sorted, so partitions and their
    order follow from the rows alone.  Rows that one task could take stay as
    they come if that is in at most ``FEW_TASKS`` partitions."""
    held = [rows.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        parts = max(1, -(-rows.count() // rows_per_task))
        if parts > 1 or rows.rdd.getNumPartitions() > FEW_TASKS:
            even = rows.repartition(parts, *rows.columns).sortWithinPartitions(*rows.columns).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(even)
            even.count()  # persisted before threads read it
            held.pop(0).unpersist()
        yield held[-1]
    finally:
        for df in held:
            df.unpersist()


def _fit_prepared(rows, family, inputs, label_col, prediction_col, handle_invalid, order_keys, **params) -> PipelineModel:
    if family == "rf":
        return fit_forest(rows, inputs, label_col, prediction_col, handle_invalid, order_keys, **params)
    return Pipeline(stages=[assembler(inputs, handle_invalid=handle_invalid), estimator(family, label_col, prediction_col, **params)]).fit(rows)


#: Rows that the bins of a forest's inputs are cut by, about.
BIN_ROWS = 100_000
#: Trees of a forest that are fitted side by side.
TREES_AT_ONCE = 4


def poisson_weight(keys: Sequence[str], tree: int, seed: int, rate: float = 1.0) -> Column:
    """How often a row is drawn for a tree's bag: a Poisson value from a hash
    of the row's key, the tree and the seed, so it depends on nothing else."""
    u = hash_unit([F.lit(tree), *keys], seed)
    drawn, below, chance = F.lit(0), 0.0, math.exp(-rate)
    for n in range(1, 16):
        below += chance
        drawn = drawn + F.when(u >= below, 1).otherwise(0)
        chance *= rate / n
    return drawn.cast("double")


def bin_edges(rows: DataFrame, inputs: Sequence[str], keys: Sequence[str], seed: int, bins: int, sample_rows: int = BIN_ROWS) -> list[list[float]]:
    """Inner edges of at most ``bins`` bins of equal counts for each input,
    from rows chosen by a hash of their keys: the same whatever the layout."""
    n = rows.count()
    some = rows.where(hash_unit(keys, seed) < min(1.0, sample_rows / n)) if n > sample_rows else rows
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    found = some.agg(*[F.percentile(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), shares).alias(f"_cf_{i}") for i, c in enumerate(inputs)]).first()
    return [sorted(set(found[i] or ())) for i in range(len(inputs))]


def fit_forest(
    rows: DataFrame,
    inputs: Sequence[str] = schemas.MODEL_INPUTS,
    label_col: str = schemas.LABEL,
    prediction_col: str = "prediction",
    handle_invalid: str = "skip",
    order_keys: Sequence[str] = (schemas.SYMBOL, schemas.OPEN_TIME),
    **params,
) -> PipelineModel:
    """M4: a random forest that the layout of the rows has no say in.

    Spark draws its bags by the number of the partition and the place in it,
    so the same rows in other partitions give another forest.  Here a tree's
    bag is a weight per row (see :func:`poisson_weight`), handed as
    ``weightCol`` to Spark's own learner, which fits one tree at a time
    without a bag of its own; and the inputs are cut into bins first (see
    :func:`bin_edges`), since the learner samples rows for its candidate
    splits.  The trees are put together to one Spark forest model, which
    saves, loads and predicts like any other; the model's bins are part of
    the pipeline.  4, 16 or 400 partitions give the same splits.

    The price: every tree reads the rows on its own, ``TREES_AT_ONCE`` side by
    side, where Spark's forest grows all trees in one pass per level.
    ``order_keys`` must name the rows; rows with equal keys share their draws.
    """
    settings = {**schemas.RF_PARAMS, **params}
    trees, seed = settings.pop("numTrees"), settings.pop("seed")
    bins = settings.get("maxBins", 32)
    keys = [k for k in order_keys if k in rows.columns] or list(inputs)
    settings.setdefault("featureSubsetStrategy", "onethird" if trees > 1 else "all")
    edges = bin_edges(rows, inputs, keys, seed, bins)
    binned = [f"_cf_bin_{i}" for i in range(len(inputs))]
    # An input of one value has no edge; any value is then its single bin.
    splits = [[-math.inf, *(e or [0.0]), math.inf] for e in edges]
    cutter = Bucketizer(splitsArray=splits, inputCols=list(inputs), outputCols=binned, handleInvalid=handle_invalid)
    front = Pipeline(stages=[cutter, assembler(binned, handle_invalid=handle_invalid)]).fit(rows)
    ready = front.transform(rows).select("features", F.col(label_col).cast("double").alias(label_col), *[F.col(k) for k in keys]).persist(StorageLevel.MEMORY_AND_DISK)

    def grow(tree: int):
        bag = ready.withColumn("_cf_drawn", poisson_weight(keys, tree, seed)).where("_cf_drawn > 0")
        learner = RandomForestRegressor(featuresCol="features", labelCol=label_col, weightCol="_cf_drawn", numTrees=1, bootstrap=False, subsamplingRate=1.0, seed=seed + tree, **settings)
        return learner.fit(bag)._java_obj.trees()[0]

    try:
        with ThreadPoolExecutor(max_workers=TREES_AT_ONCE) as pool:
            grown = list(pool.map(grow, range(trees)))
    finally:
        ready.unpersist()
    sc = rows.sparkSession.sparkContext
    array = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, trees)
    for i, tree in enumerate(grown):
        array[i] = tree
    java = sc._jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(f"RandomForestRegressor_{seed}", array, len(inputs))
    java.set(java.getParam("numTrees"), trees)  # saved models are checked against it
    forest = RandomForestRegressionModel(java).setFeaturesCol("features").setPredictionCol(prediction_col)
    return PipelineModel([*front.stages, forest])


def compare_models(
    train: DataFrame,
    test: DataFrame,
    families: Sequence[str] = FAMILIES,
    label_col: str = schemas.LABEL,
    digits: int | None = None,
) -> DataFrame:
    """Fit every family on the same split and report ``(model, metric,
    value)`` for each on the test rows.

    The training rows are persisted once for all families, in even partitions
    (see :func:`evened`).  The fits are independent Spark jobs and are submitted from one driver thread
    each, so the many small jobs of 100 boosting rounds do not keep the
    executors idle while the other families wait.  The test rows are read
    once and get a prediction column per family; rows that a model can't
    score are left out, as they were in training."""
    keys = (schemas.SYMBOL, schemas.OPEN_TIME)
    with evened(prepared(train, schemas.MODEL_INPUTS, label_col, keys)) as rows:
        with ThreadPoolExecutor(max_workers=max(1, len(families))) as pool:
            models = list(pool.map(
                lambda fam: _fit_prepared(rows, fam, schemas.MODEL_INPUTS, label_col, f"_cf_{fam}", "skip", keys), families))
    scored = test.where(F.col(label_col).isNotNull())
    for model in models:
        scored = model.transform(scored).drop("features")
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.col(f"_cf_{f}").alias("prediction")) for f in families]))
    long = scored.select(F.col(label_col), pairs.alias("p")).select(label_col, "p.family", "p.prediction")
    report = regression_metrics(long, label_col, "prediction", partition_by=["family"], digits=digits)
    return report.select(F.col("family").alias("model"), "metric", "value")
