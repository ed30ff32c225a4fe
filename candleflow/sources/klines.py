"""Landed kline files: JSON arrays of 12-field positional arrays.

A landed file holds the body of one candle request, e.g.
``[[1700000000000,"37000.1","37010.0",...,"0"], ...]``.  The HTTP call that
fetches it is outside this library; we read what has landed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import epoch_ms_to_timestamp, to_double, to_long
from ..session import materialize


def _typed(row: Column, symbol: Column) -> list[Column]:
    """Positional array of strings -> typed bronze columns; a field that a
    short row lacks is NULL."""
    out = [symbol.alias("symbol")]
    for i, name in enumerate(schemas.KLINE_FIELDS):
        raw = F.get(row, F.lit(i))
        if name in schemas.KLINE_TIME_FIELDS:
            out.append(epoch_ms_to_timestamp(raw).alias(name))
        elif name in schemas.KLINE_PRICE_FIELDS:
            out.append(to_double(raw).alias(name))
        elif name == "number_of_trades":
            out.append(to_long(raw).alias(name))
        else:
            out.append(raw.alias(name))
    return out


#: Why a row or a body is no candle.
BAD_BODY, BAD_ROW, SHORT_ROW, BAD_TIME, BAD_NUMBER = "body is no array of arrays", "row is no array", "row has fewer than 12 fields", "bad time", "bad number"


def _fault(row: Column) -> Column:
    """Why a positional row is no complete candle; NULL for a good one."""
    times = [epoch_ms_to_timestamp(F.get(row, F.lit(i))) for i, f in enumerate(schemas.KLINE_FIELDS) if f in schemas.KLINE_TIME_FIELDS]
    numbers = [to_double(F.get(row, F.lit(i))) for i, f in enumerate(schemas.KLINE_FIELDS) if f in schemas.KLINE_PRICE_FIELDS]
    numbers.append(to_long(F.get(row, F.lit(schemas.KLINE_FIELDS.index("number_of_trades")))))

    def first_null(columns: list[Column], kind: str, names: Sequence[str]) -> Column:
        return F.coalesce(*[F.when(c.isNull(), F.lit(f"{kind}: {n}")) for c, n in zip(columns, names, strict=True)])

    return (F.when(row.isNull(), BAD_ROW).when(F.size(row) < len(schemas.KLINE_FIELDS), SHORT_ROW)
            .otherwise(F.coalesce(first_null(times, BAD_TIME, schemas.KLINE_TIME_FIELDS),
                                  first_null(numbers, BAD_NUMBER, [*schemas.KLINE_PRICE_FIELDS, "number_of_trades"]))))


def _kline_rows(text: DataFrame, symbol: str | Column, value_col: str) -> DataFrame:
    """One row per positional row of all bodies, and one per body that is
    none: symbol, the file (where the text comes from files), the place in the
    body, the row and its fault.  The body is parsed once."""
    sym = F.lit(symbol) if isinstance(symbol, str) else symbol
    bodies = text.where(F.trim(value_col) != "").select(
        sym.alias("_cf_sym"), F.input_file_name().alias("_cf_file"), F.col(value_col).alias("_cf_body"), F.from_json(F.col(value_col), schemas.RAW_KLINE).alias("_cf_rows"))
    parsed = bodies.select("_cf_sym", "_cf_file", F.when(F.col("_cf_rows").isNull(), F.col("_cf_body")).alias("_cf_body"), F.posexplode_outer("_cf_rows").alias("_cf_at", "_cf_row"))
    fault = F.when(F.col("_cf_body").isNotNull(), BAD_BODY).when(F.col("_cf_at").isNotNull(), _fault(F.col("_cf_row")))
    return parsed.where("_cf_at is not null or _cf_body is not null").withColumn("_cf_fault", fault)


def parse_klines(text: DataFrame, symbol: str | Column, value_col: str = "value", on_bad: str = "error") -> DataFrame:
    """Parse a DataFrame of JSON texts (one landed body per row) into bronze
    rows.  Works on batch and streaming frames alike.

    ``on_bad`` says what happens to bodies that are no array of arrays, such
    as a server's error message, and to rows of fewer than 12 fields:
    ``"error"`` stops the job, ``"skip"`` leaves them out.  Numbers and times
    are cast with ``try_cast``: a bad one becomes NULL and the silver null
    policy drops the row.  ``"quarantine"`` leaves out every row with a fault,
    bad numbers and times too; :func:`rejected_klines` lists what is left out.
    Good rows of a body stay.  Blank texts are no bodies."""
    if on_bad not in ("error", "skip", "quarantine"):
        raise ValueError(f"unknown policy {on_bad!r}")
    rows = _kline_rows(text, symbol, value_col)
    broken = F.coalesce(F.col("_cf_fault").isin(BAD_BODY, BAD_ROW, SHORT_ROW), F.lit(False))
    if on_bad == "quarantine":
        rows = rows.where(F.col("_cf_fault").isNull())
    elif on_bad == "skip":
        rows = rows.where(~broken)
    else:
        shown = F.coalesce("_cf_body", F.to_json(F.array("_cf_row")))
        message = F.concat(F.lit("no kline body: "), F.col("_cf_fault"), F.lit(": "), F.substring(shown, 1, 200))
        rows = rows.where(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return rows.select(*_typed(F.col("_cf_row"), F.col("_cf_sym")))


def rejected_klines(text: DataFrame, symbol: str | Column, value_col: str = "value") -> DataFrame:
    """What :func:`parse_klines` leaves out under ``on_bad="quarantine"``:
    symbol, file, place (of the row in its body, from 0; NULL for a whole
    body), reason and raw (the row as JSON, or the body)."""
    rows = _kline_rows(text, symbol, value_col).where(F.col("_cf_fault").isNotNull())
    return rows.select(F.col("_cf_sym").alias("symbol"), F.col("_cf_file").alias("file"), F.col("_cf_at").alias("place"),
                       F.col("_cf_fault").alias("reason"), F.coalesce("_cf_body", F.to_json("_cf_row")).alias("raw"))


def split_klines(text: DataFrame, symbol: str | Column, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good bronze rows and rejected ones (see :func:`rejected_klines`) from
    one scan of the landed texts: the parsed rows are written once to the
    shared checkpoint folder and read twice."""
    rows = materialize(_kline_rows(text, symbol, value_col), "kline-rows")
    good = rows.where(F.col("_cf_fault").isNull()).select(*_typed(F.col("_cf_row"), F.col("_cf_sym")))
    bad = rows.where(F.col("_cf_fault").isNotNull()).select(
        F.col("_cf_sym").alias("symbol"), F.col("_cf_file").alias("file"), F.col("_cf_at").alias("place"),
        F.col("_cf_fault").alias("reason"), F.coalesce("_cf_body", F.to_json("_cf_row")).alias("raw"))
    return good, bad


def rejected_bodies(text: DataFrame, value_col: str = "value") -> DataFrame:
    """The rows of ``text`` whose body is no array of arrays."""
    parsed = F.from_json(F.col(value_col), schemas.RAW_KLINE)
    broken = parsed.isNull() | F.exists(parsed, lambda r: r.isNull())
    return text.where((F.trim(value_col) != "") & F.coalesce(broken, F.lit(True)))


def symbol_from_path(pattern: str = r"([^/_]+)(?:_[^/]*)?\.json$") -> Column:
    """The symbol taken from the landed file's name: all of it up to the
    first ``_`` or the extension (``BTC-USDT_1m.json`` is ``BTC-USDT``).  A
    name that doesn't match stops the job."""
    name = F.input_file_name()
    found = F.regexp_extract(name, pattern, 1)
    return F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no symbol in the file name "), name)).cast("string"))


def read_klines(
    spark: SparkSession,
    path: str | Sequence[str],
    symbol: str | Column | None = None,
    whole_file: bool | None = None,
    on_bad: str = "error",
) -> DataFrame:
    """Read landed kline files into bronze rows (``on_bad`` as in
    :func:`parse_klines`).

    A landed file is one response body (``whole_file=True``, one task per
    file) or a text file with one body per line (``whole_file=False``,
    split like any text file).  The default is line mode for a folder laid
    out as ``symbol=<name>/...`` and whole-file mode otherwise.  ``symbol``
    is a constant or an expression; when omitted it comes from the
    ``symbol=`` folder or else from the file name.
    """
    text, sym = landed_texts(spark, path, symbol, whole_file)
    return parse_klines(text, sym, on_bad=on_bad)


def landed_texts(spark: SparkSession, path: str | Sequence[str], symbol: str | Column | None = None, whole_file: bool | None = None) -> tuple[DataFrame, str | Column]:
    """The landed bodies of :func:`read_klines`, one a row, and their symbol."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    folders = "symbol" in reader.text(paths).columns
    whole = whole_file if whole_file is not None else not folders
    # The symbol is text whatever it looks like ("007").
    reader = reader.schema("value string, symbol string" if folders else "value string")
    text = reader.option("wholetext", "true").text(paths) if whole else reader.text(paths)
    if symbol is not None:
        sym = symbol
    elif "symbol" in text.columns:
        sym = F.col("symbol").cast("string")
    else:
        sym = symbol_from_path()
    return text, sym


def klines_frame(
    spark: SparkSession, rows: Iterable[Sequence], symbol: str
) -> DataFrame:
    """Bronze rows from positional rows already in memory (the reference's
    ``createDataFrame(data, columns)``), with an explicit raw schema: every
    field is kept as text first and cast exactly as landed files are."""
    raw = [[None if v is None else str(v) for v in r] for r in rows]
    df = spark.createDataFrame([(r,) for r in raw], "r array<string>")
    return df.select(*_typed(F.col("r"), F.lit(symbol)))
