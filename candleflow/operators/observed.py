"""Quality counts taken by the job that writes a table.

``quality.null_counts`` scans a table on its own.  Here the counts are
aggregates that Spark's ``Observation`` collects from the rows on their way
to the files, so the report costs no further scan and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .clean import present

REPORT = "stage string, metric string, value long"


class QualityCounts:
    """The counts of one write: ``n_rows``, ``nulls_<column>`` and
    ``complete_rows`` (rows without NULL or NaN in ``columns``).

    ``watch`` belongs right before the write, behind its last shuffle: there
    every task's rows count once, also when the task is run again.  ``get``
    waits for the write, so call it after one that succeeded."""

    def __init__(self, columns: Sequence[str] | None = None):
        self.columns = columns
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        cols = [c for c in (self.columns or df.columns) if c in df.columns]
        return df.observe(
            self.observation,
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(present(df, cols)).alias("complete_rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in cols],
        )

    def get(self) -> dict[str, int]:
        return {name: int(value or 0) for name, value in self.observation.get.items()}


def duplicate_rows(before: dict[str, int], after: dict[str, int]) -> int:
    """How many complete rows the keyed de-duplication between two writes took
    out: it keeps one complete row of every key that has one, so the rows
    written after it are the distinct keys."""
    return before["complete_rows"] - after["n_rows"]


def quality_report(spark, counts: dict[str, dict[str, int]]) -> DataFrame:
    """The counts of all stages as rows (stage, metric, value)."""
    rows = [(stage, metric, value) for stage, found in counts.items() for metric, value in found.items()]
    return spark.createDataFrame(rows, REPORT)
