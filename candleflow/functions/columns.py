"""Column expressions used across the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator / denominator`` that yields NULL on a zero denominator
    instead of raising under ANSI mode."""
    return F.try_divide(col(numerator), col(denominator))


def pct_change(current: ColumnOrName, previous: ColumnOrName) -> Column:
    """One-step return ``(current - previous) / previous`` (NULL when the
    previous value is NULL or zero)."""
    return F.try_divide(col(current) - col(previous), col(previous))


def epoch_ms_to_timestamp(c: ColumnOrName) -> Column:
    """Epoch milliseconds (number or numeric text) to TIMESTAMP, without a
    floating-point division; NULL for what is no time of the years 1 to 9999."""
    ms = col(c).try_cast("bigint")
    return F.when(ms.between(-62_135_596_800_000, 253_402_300_799_999), F.timestamp_millis(ms))


def utc_instant(c: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ read as a UTC wall clock -> TIMESTAMP (an instant).

    Built from calendar fields, so the session time zone plays no part
    (a cast would read the wall clock in the session zone and move times
    that fall in a daylight-saving gap)."""
    t = col(c)
    micros = (
        F.unix_date(F.to_date(t)).cast("bigint") * F.lit(86_400_000_000)
        + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(t).cast("bigint") * F.lit(60_000_000)
        + (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint")
    )
    return F.timestamp_micros(micros)


def utc_wallclock(c: ColumnOrName) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding its UTC wall clock,
    independent of the session time zone."""
    seconds = F.unix_micros(col(c)).cast("decimal(20,0)") / F.lit(1_000_000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def as_instant(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as TIMESTAMP; TIMESTAMP_NTZ is read as UTC."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return utc_instant(name)
    return F.col(name).cast("timestamp")


def nanos_to_timestamp(c: ColumnOrName) -> Column:
    """Epoch nanoseconds read as BIGINT (foreign nanosecond Parquet) to a
    microsecond TIMESTAMP."""
    return F.timestamp_micros(F.floor(col(c) / F.lit(1000)).cast("bigint"))


def to_double(c: ColumnOrName) -> Column:
    """Text or number to DOUBLE; unparsable text becomes NULL."""
    return col(c).try_cast("double")


def to_long(c: ColumnOrName) -> Column:
    return col(c).try_cast("bigint")


def any_null(columns: Iterable[ColumnOrName], nan_is_null: bool = False) -> Column:
    """TRUE when at least one of the columns is NULL (or NaN when asked)."""
    checks = []
    for c in columns:
        e = col(c)
        checks.append(e.isNull() | F.isnan(e) if nan_is_null else e.isNull())
    return reduce(or_, checks) if checks else F.lit(False)


def train_cutoff(n: ColumnOrName, numerator: int = 8, denominator: int = 10) -> Column:
    """``floor(n * numerator / denominator)``, which is what ``int(n * 0.8)``
    gives.  ``n * numerator`` is an exact integer and the quotient is exact
    to far below one for any row count under 10**14, so the floor is right."""
    scaled = col(n).cast("bigint") * F.lit(int(numerator))
    return F.floor(scaled / F.lit(float(denominator))).cast("bigint")


def hash_unit(keys: Iterable[ColumnOrName], seed: int = 42) -> Column:
    """A reproducible number in [0, 1) per row, derived from the row's key
    columns.  Unlike ``DataFrame.sample`` it does not depend on how the data
    happens to be partitioned."""
    h = F.xxhash64(F.lit(seed), *[col(k) for k in keys])
    return F.pmod(h, F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))


def linear_combination(weights: dict[str, float], intercept: float = 0.0) -> Column:
    """``intercept + sum(w_i * x_i)`` over named input columns."""
    expr = F.lit(float(intercept))
    for name, w in weights.items():
        expr = expr + F.lit(float(w)) * col(name).cast("double")
    return expr


def numeric_columns(df: DataFrame, legacy: bool = False) -> list[str]:
    """Names of the numeric columns of ``df``.  ``legacy=True`` keeps only
    INT and DOUBLE columns, so BIGINT columns are left out."""
    if legacy:
        kinds: tuple[type, ...] = (T.IntegerType, T.DoubleType)
    else:
        kinds = (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def round_columns(df: DataFrame, columns: Iterable[str], digits: int = 6) -> DataFrame:
    """Round the named columns in place (for comparisons with an oracle)."""
    wanted = set(columns)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in wanted else F.col(c) for c in df.columns])
