"""Sinks: Parquet tables, JDBC tables, prediction and metric appends, and
model saves."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import as_instant


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    replace: str = "partitions",
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write a Parquet table.

    With ``partition_by`` and ``mode="overwrite"``, ``replace="partitions"``
    replaces only the partitions present in ``df``, so refreshing one symbol
    leaves the others alone; ``replace="table"`` replaces everything at
    ``path``.  The rows are rebalanced by the partition columns: a value's
    rows meet in few tasks and so in few files, and the rebalance splits a
    value that holds too much for one task.

    ``watch`` (see ``operators.observed``) gets the rows behind the rebalance,
    as they are written.
    """
    if replace not in ("partitions", "table"):
        raise ValueError(f"unknown replacement {replace!r}")
    parts = list(partition_by)
    rows = df.hint("rebalance", *parts) if parts else df
    rows = watch(rows) if watch else rows
    writer = rows.sortWithinPartitions(*parts) if parts else rows
    w = writer.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts).option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: dict[str, str] | None = None,
    num_partitions: int | None = None,
    batch_size: int = 10_000,
) -> None:
    """Write a relational table over JDBC (``overwrite`` replaces it,
    ``append`` adds rows).  Every task writes its own rows in batches;
    ``num_partitions`` caps the number of concurrent connections (the JDBC
    writer coalesces to it)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        props["numPartitions"] = str(int(num_partitions))
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)


def read_jdbc(spark, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Read a relational table over JDBC."""
    return spark.read.jdbc(url=url, table=table, properties=dict(properties or {}))


RUN_ID = "run_id"


def _write_run(rows: DataFrame, path: str, run_id: str | None, fmt: str = "parquet") -> str:
    """Write ``rows`` as the folder ``run_id=<id>`` of the table at ``path``,
    replacing what an earlier attempt of the same run left there and nothing
    else.  Spark stages the files and moves the folder into place when all
    tasks are done, so a lost job leaves the table as it was."""
    run_id = run_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"a run id is made of letters, digits, dots, hyphens and underscores, not {run_id!r}")
    named = rows.withColumn(RUN_ID, F.lit(run_id))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_ID).format(fmt).save(path)
    return run_id


def append_predictions(predictions: DataFrame, path: str, fmt: str = "parquet", run_id: str | None = None) -> str:
    """K4: add prediction records (see ``score.to_predictions``) to a table,
    which the first run creates; returns the run id.

    A run's records are one partition of the table.  Writing a run again under
    its id replaces them, so a retried job adds nothing; without an id every
    call is a run of its own.  A run without records adds nothing and replaces
    nothing.  ``read_runs`` reads the table."""
    cols = [f.name for f in schemas.PREDICTION.fields]
    extra = [c for c in predictions.columns if c not in (*cols, RUN_ID)]
    return _write_run(predictions.select(*cols, *extra), path, run_id, fmt)


def append_metrics(metrics: DataFrame, path: str, run_id: str | None = None) -> str:
    """K7: add a ``(model, metric, value)`` report, stamped with the run time,
    to a table of all runs, under the rules of :func:`append_predictions`."""
    return _write_run(metrics.select("*", F.current_timestamp().alias("run_at")), path, run_id)


def append_quality(report: DataFrame, path: str, run_id: str | None = None) -> str:
    """Add the quality report of a run (see ``operators.observed``) to a table
    of all runs, under the rules of :func:`append_predictions`."""
    return _write_run(report, path, run_id)


def read_runs(spark: SparkSession, path: str, run_id: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The records of all runs in a table of runs, or of one.  Ids stay text
    whatever they look like."""
    schema = spark.read.format(fmt).load(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == RUN_ID else f for f in schema.fields]
    rows = spark.read.format(fmt).schema(T.StructType(fields)).load(path)
    return rows if run_id is None else rows.where(F.col(RUN_ID) == run_id)


def write_kline_bodies(
    candles: DataFrame, path: str, time_col: str = schemas.OPEN_TIME, mode: str = "overwrite"
) -> None:
    """Write candles back in the landed raw form: one JSON body per symbol
    and day (an array of 12-field arrays, numbers as text, times as epoch
    ms), in folders ``symbol=<name>``.  A body holds one day of one
    symbol's candles, which the candle interval bounds (1,440 one-minute
    candles at most once keys are unique)."""
    def text(c):
        return F.col(c).cast("string")

    def millis(c):
        return F.unix_millis(as_instant(candles, c)).cast("string")

    fields = []
    for name in schemas.KLINE_FIELDS:
        if name in schemas.KLINE_TIME_FIELDS:
            fields.append(millis(name))
        elif name == "ignore":
            fields.append(F.lit("0"))
        else:
            fields.append(text(name))
    rows = candles.select(
        schemas.SYMBOL,
        F.to_date(F.col(time_col)).alias("_cf_day"),
        F.struct(F.col(time_col).alias("t"), F.array(*fields).alias("r")).alias("_cf_kline"),
    )
    bodies = rows.groupBy(schemas.SYMBOL, "_cf_day").agg(
        F.to_json(F.transform(F.sort_array(F.collect_list("_cf_kline")), lambda s: s["r"])).alias("value")
    )
    bodies.select(schemas.SYMBOL, "value").write.mode(mode).partitionBy(schemas.SYMBOL).text(path)


def save_model(model: MLWritable, path: str) -> None:
    """Save a model, replacing what is at ``path``."""
    model.write().overwrite().save(path)
