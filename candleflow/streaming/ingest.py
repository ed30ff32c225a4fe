"""Streaming sources and stateless/stateful row operators.

* :func:`kline_stream` (T1) reads landed kline files incrementally.
* :func:`dedup_stream` removes repeated candles within a watermark, where a
  consumer wants each key once and can do without late data; the feature
  stream merges copies itself and drops nothing (see ``incremental``).
* :func:`start_bars` / :func:`read_bars` are the streaming form of the
  events-to-bars adapter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.columns import utc_instant
from ..sources.events import BAR_INTERVAL, bar_parts, finished, merge_parts, ticks
from ..sources.klines import parse_klines, symbol_from_path


def kline_stream(
    spark: SparkSession,
    landed_dir: str,
    whole_file: bool | None = None,
    max_files_per_trigger: int | None = None,
    symbol: str | None = None,
    on_bad: str = "error",
) -> DataFrame:
    """Bronze rows from kline files as they land in ``landed_dir``.

    The defaults are those of ``sources.klines.read_klines``: line mode for a
    folder laid out as ``symbol=<name>/...``, whole files otherwise.  The
    symbol comes from the ``symbol=`` folder, a constant, or the file name; a
    body or row that can't be read is treated as ``on_bad`` says (see ``parse_klines``).
    """
    folders = "symbol" in spark.read.text(landed_dir).columns
    reader = spark.readStream.format("text").schema("value string, symbol string" if folders else "value string")
    if not folders if whole_file is None else whole_file:
        reader = reader.option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    text = reader.load(landed_dir)
    if symbol is not None:
        sym = F.lit(symbol)
    elif "symbol" in text.columns:
        sym = F.col("symbol")
    else:
        sym = symbol_from_path()
    return parse_klines(text, sym, on_bad=on_bad)


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str] = (schemas.SYMBOL, schemas.OPEN_TIME),
    time_col: str = schemas.OPEN_TIME,
    watermark: str = "1 day",
) -> DataFrame:
    """Drop repeated keys within ``watermark`` of event time.  Repeats that
    arrive later than the watermark are dropped by Spark as late data; the
    batch refresh keeps them (keyed de-duplication over the whole table).
    Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as UTC."""
    ts = df.schema[time_col].dataType
    if isinstance(ts, T.TimestampNTZType):
        df = df.withColumn(time_col, utc_instant(time_col))
    return df.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table as a file stream (schema taken from the files
    present now)."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def start_bars(
    events: DataFrame, out_path: str, checkpoint: str, interval: str = BAR_INTERVAL, available_now: bool = True
) -> StreamingQuery:
    """Bars of an event stream.  Every micro-batch writes the parts of bars
    that its events make to ``out_path``, in a folder ``batch_id=N`` that a
    retry overwrites; :func:`read_bars` puts the parts together.  There is no
    watermark and no state: an event counts however late it comes, and the
    newest bar is there as far as its events are."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bar_parts(ticks(batch, interval)).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_bars(spark: SparkSession, out_path: str, interval: str = BAR_INTERVAL) -> DataFrame:
    """The bars that :func:`start_bars` keeps, with the silver candle columns."""
    return finished(merge_parts(spark.read.parquet(out_path)), interval)
