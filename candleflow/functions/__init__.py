"""Column expressions (all built-in Spark expressions)."""

from .columns import (
    any_null,
    as_instant,
    epoch_ms_to_timestamp,
    hash_unit,
    linear_combination,
    nanos_to_timestamp,
    numeric_columns,
    pct_change,
    round_columns,
    safe_ratio,
    to_double,
    to_long,
    train_cutoff,
    utc_instant,
    utc_wallclock,
)

__all__ = [
    "any_null",
    "as_instant",
    "epoch_ms_to_timestamp",
    "hash_unit",
    "linear_combination",
    "nanos_to_timestamp",
    "numeric_columns",
    "pct_change",
    "round_columns",
    "safe_ratio",
    "to_double",
    "to_long",
    "train_cutoff",
    "utc_instant",
    "utc_wallclock",
]
