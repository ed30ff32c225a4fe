"""Session helpers: building a local session for tests and finding the
shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "candleflow") -> SparkSession:
    """A local session for tests and the bench.  On a cluster the caller
    builds the session; nothing here hard-codes memory or the master."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CANDLEFLOW_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; we only read it.  A
    folder of our own is set only when neither the context nor the conf has
    one and the master is local (tests); on a cluster that is an error, as a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="candleflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Scratch folders created by this process, for release_scratch, and the
# scopes open in the current thread (see scratch_scope).
_SCRATCH: list[str] = []
_SCOPES = threading.local()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the shared checkpoint folder for a written
    intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/candleflow-{tag}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    for scope in getattr(_SCOPES, "open", []):
        scope.append(path)
    return path


def delete_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders on the file system Spark uses for them; returns how
    many existed and were removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path) and fs.delete(path, True):
            removed += 1
    return removed


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process created and return how many
    were removed.  Call it when the DataFrames built on them are no longer
    needed (e.g. at the end of a job): later actions on those DataFrames
    would find their files gone."""
    paths = list(_SCRATCH)
    _SCRATCH.clear()
    return delete_paths(spark, paths)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, on exit, the scratch folders created inside the block by the
    current thread (e.g. one stream micro-batch), whose results have been
    written elsewhere by then."""
    scope: list[str] = []
    open_scopes = getattr(_SCOPES, "open", [])
    _SCOPES.open = [*open_scopes, scope]
    try:
        yield scope
    finally:
        _SCOPES.open = open_scopes
        delete_paths(spark, scope)
        gone = set(scope)
        _SCRATCH[:] = [p for p in _SCRATCH if p not in gone]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (file-system metadata, no Spark job)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def materialize_at(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """:func:`materialize` that also returns the folder written."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it
    back.  This cuts the lineage (a lost executor re-reads the files instead
    of recomputing non-deterministic steps) and makes later passes columnar,
    so they read only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    # The schema is known, so reading back needs no footer-inference job.
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
