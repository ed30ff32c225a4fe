"""Parquet table reads with declared schemas and compatibility options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import nanos_to_timestamp
from ..sinks.versions import current_version


class EmptyInputError(RuntimeError):
    """Raised when a stage input exists but has no rows."""


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    legacy_calendar: bool = False,
    require_rows: bool = False,
    text_columns: Sequence[str] = (),
) -> DataFrame:
    """Read a Parquet directory or file, or the current version of a table
    that ``sinks.versions.publish`` keeps.

    ``text_columns`` are partition columns to read as text whatever their
    folders look like (a symbol "007" would be read as the number 7).
    ``schema`` declares the columns instead of trusting the footer.
    ``legacy_calendar`` reads dates and INT96 timestamps written by old
    writers without rebasing.  A missing path raises Spark's
    ``PATH_NOT_FOUND``; ``require_rows`` also raises on an empty input (a
    one-row probe, not a count).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if legacy_calendar:
        reader = reader.option("datetimeRebaseMode", "CORRECTED").option("int96RebaseMode", "CORRECTED")
    at = current_version(spark, path.rstrip("/")) or path
    df = reader.parquet(at)
    if schema is None and any(df.schema[c].dataType != T.StringType() for c in text_columns if c in df.columns):
        fields = [T.StructField(f.name, T.StringType()) if f.name in text_columns else f for f in df.schema.fields]
        df = reader.schema(T.StructType(fields)).parquet(at)
    if require_rows and df.isEmpty():
        raise EmptyInputError(f"no rows in {path}")
    return df


def read_nanos_parquet(spark: SparkSession, path: str, nanos_columns: list[str]) -> DataFrame:
    """Read Parquet written with nanosecond timestamps (which Spark refuses)
    and convert the named columns to microsecond TIMESTAMPs.

    Needs ``spark.sql.legacy.parquet.nanosAsLong=true`` on the session, set
    by the caller, so the columns arrive as BIGINT nanoseconds.
    """
    flag = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false")
    if str(flag).lower() != "true":
        raise RuntimeError("set spark.sql.legacy.parquet.nanosAsLong=true to read nanosecond Parquet")
    df = spark.read.parquet(path)
    return df.select(*[nanos_to_timestamp(c).alias(c) if c in nanos_columns else c for c in df.columns])
