"""Folders that are complete or not there.

Spark's overwrite deletes the old files before the new ones are in place, so a
job lost midway leaves no table.  Here every replacement writes a folder
``version=N`` of its own next to the earlier ones, and an empty file marks it
when all of it is written.  Creating one file is atomic on every file system,
so readers, who take the newest marked folder, see the old table or the new
one.  Earlier versions stay until :func:`release_versions`, for readers that
have planned on them; folders without a mark are left-overs of lost jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_paths
from .writers import write_parquet

MARK = "_PUBLISHED"
PREFIX = "version="


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``, from one listing; none if
    it doesn't exist."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def numbered(spark: SparkSession, folder: str, prefix: str = PREFIX) -> list[int]:
    """The numbers N of the folders ``<prefix>N`` in ``folder``, ascending."""
    tails = [name.removeprefix(prefix) for name in children(spark, folder) if name.startswith(prefix)]
    return sorted(int(t) for t in tails if t.removeprefix("-").isdigit())


def published(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the complete versions under ``root``, ascending."""
    return [n for n in numbered(spark, root) if MARK in children(spark, f"{root}/{PREFIX}{n}")]


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest complete version, or None."""
    for n in reversed(numbered(spark, root)):
        if MARK in children(spark, f"{root}/{PREFIX}{n}"):
            return f"{root}/{PREFIX}{n}"
    return None


@contextmanager
def new_version(spark: SparkSession, root: str, number: int | None = None) -> Iterator[str]:
    """The folder to write the next version to; it is marked at the end of the
    block, unless the block raises.  ``number`` names the version (it must be
    newer than the current one); one writer at a time."""
    root = root.rstrip("/")
    taken = numbered(spark, root)
    n = number if number is not None else (taken[-1] + 1 if taken else 1)
    if published(spark, root)[-1:] >= [n]:
        raise ValueError(f"version {n} of {root} isn't newer than the current one")
    path = f"{root}/{PREFIX}{n}"
    delete_paths(spark, [path])
    yield path
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARK}")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), watch: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """K1: replace the table at ``root`` by ``df``; returns the folder of the
    new version.  ``sources.tables.read_table`` reads the newest.  ``watch``
    goes to ``write_parquet``."""
    with new_version(df.sparkSession, root) as path:
        write_parquet(df, path, partition_by=partition_by, replace="table", watch=watch)
    return path


def release_versions(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all but the ``keep`` newest complete versions, and what lost
    jobs left; returns how many folders went."""
    if keep < 1:
        raise ValueError("the current version must stay")
    stay = published(spark, root)[-keep:]
    return delete_paths(spark, [f"{root}/{PREFIX}{n}" for n in numbered(spark, root) if n not in stay])
