"""The whole flow in dependency order: bronze -> silver -> features ->
split -> model -> metrics (and an optional relational export).

Each stage reads the previous stage's written table, as the reference's
stages do, so a failed stage can be re-run alone and a lost executor never
recomputes more than one stage.  Everything runs in the caller's session;
the driver only sees row counts and the metric rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.clean import to_silver
from ..operators.features import features
from ..operators.metrics import regression_metrics
from ..operators.ml import fit
from ..operators.observed import QualityCounts, duplicate_rows, quality_report
from ..operators.score import score, to_predictions
from ..operators.sketches import DAY, sketch_columns
from ..operators.split import chrono_split, train_test
from ..session import materialize
from ..sinks.versions import publish, release_versions
from ..sinks.writers import append_metrics, append_predictions, append_quality, read_runs, save_model, write_jdbc
from ..sources.klines import read_klines
from ..sources.models import load_model
from ..sources.tables import EmptyInputError, read_table


#: Feature columns whose quantiles can be asked from stored sketches.
SKETCHED = (*schemas.MODEL_INPUTS, schemas.LABEL)


@dataclass
class RefreshPaths:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def features(self) -> str:
        return f"{self.root}/features"

    @property
    def sketches(self) -> str:
        return f"{self.root}/quantile_sketches"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality"

    @property
    def predictions(self) -> str:
        return f"{self.root}/test_predictions"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def model(self, family: str) -> str:
        return f"{self.root}/models/{family}"


def run_refresh(
    spark: SparkSession,
    source: DataFrame | str,
    out_root: str,
    families: Sequence[str] = ("lr",),
    null_policy: str = schemas.DEFAULT_NULL_POLICY,
    purge: int = 0,
    run_id: str | None = None,
    jdbc: dict | None = None,
) -> DataFrame:
    """Run every stage and return this run's ``(model, metric, value)``
    rows.  ``source`` is a bronze DataFrame or a folder of landed kline
    files.  ``jdbc`` (``url``, ``table``, ``properties``) also replaces a
    relational copy of the feature table.  Tables are replaced whole by a new
    version (see ``sinks.versions``; ``read_table`` reads the newest), so a
    symbol that the source no longer holds is gone from them, a re-run gives
    the same tables, and a job lost midway leaves the old ones in place.  The
    version before stays for readers that have planned on it, older ones go.
    The metrics table keeps every run, under ``run_id`` or else an id made
    here; a run repeated under its id replaces its metrics.  Tables are read back with the schema
    they were written with, so a symbol such as "007" stays text.  A stage
    without rows raises :class:`EmptyInputError` and leaves later tables as
    they are.

    The jobs that write bronze, silver and features count their rows, NULLs
    and duplicates on the way; the counts go to a table of runs under the same
    id (``RefreshPaths.quality``).  Sketches of the features by symbol and day
    are stored next to them (``RefreshPaths.sketches``; ``operators.sketches``
    answers quantiles from them)."""
    paths = RefreshPaths(out_root.rstrip("/"))
    run_id = run_id or uuid.uuid4().hex

    counts: dict[str, dict[str, int]] = {}

    def stage(df: DataFrame, path: str) -> DataFrame:
        if df.isEmpty():
            raise EmptyInputError(f"no rows for {path}")
        counter = QualityCounts([c for c in df.columns if c != "ignore"])
        publish(df, path, partition_by=[schemas.SYMBOL], watch=counter.watch)
        counts[path.rpartition("/")[2]] = counter.get()
        release_versions(spark, path, keep=2)
        return read_table(spark, path, schema=df.schema).select(*df.columns)

    bronze = stage(read_klines(spark, source) if isinstance(source, str) else source, paths.bronze)
    silver = stage(to_silver(bronze), paths.silver)
    feats = stage(features(silver, null_policy), paths.features)
    counts["silver"]["duplicate_rows"] = duplicate_rows(counts["bronze"], counts["silver"])
    append_quality(quality_report(spark, counts), paths.quality, run_id)
    dated = feats.withColumn(DAY, F.to_date(schemas.OPEN_TIME))
    publish(sketch_columns(dated, SKETCHED, [schemas.SYMBOL, DAY]), paths.sketches, partition_by=[DAY])
    release_versions(spark, paths.sketches, keep=2)
    if jdbc:
        write_jdbc(feats, jdbc["url"], jdbc["table"], properties=jdbc.get("properties"))

    split = chrono_split(feats, purge=purge)
    train, test = train_test(split)
    predictions, reports = [], []
    for family in families:
        model = fit(train, family)
        save_model(model, paths.model(family))
        scored = model.transform(test).select(
            schemas.SYMBOL, schemas.OPEN_TIME, schemas.LABEL, F.col("prediction"), F.lit(family).alias("model")
        )
        predictions.append(materialize(scored, "test-predictions"))
        reports.append(regression_metrics(predictions[-1], model=family))
    publish(reduce(DataFrame.unionByName, predictions), paths.predictions, partition_by=["model"])
    release_versions(spark, paths.predictions, keep=2)
    append_metrics(reduce(DataFrame.unionByName, reports), paths.metrics, run_id)
    return read_runs(spark, paths.metrics, run_id)


def score_table(spark: SparkSession, model_path: str, source: DataFrame | str, out_path: str, run_id: str | None = None) -> DataFrame:
    """Score a table with a saved model and add the prediction records to
    ``out_path``; returns the records of this run.  Every row is scored: one
    with a missing input gets a NaN price.  ``source`` is a feature table
    (its symbols are text, also where it is partitioned by them) or its path.
    Scoring again under the same ``run_id`` replaces the run's records."""
    model = load_model(model_path)
    rows = read_table(spark, source, require_rows=True, text_columns=[schemas.SYMBOL]) if isinstance(source, str) else source
    run_id = append_predictions(to_predictions(score(rows, model, handle_invalid="keep")), out_path, run_id=run_id)
    return read_runs(spark, out_path, run_id)
