"""Adapter from the driver's ``events`` table to candles.

This is a fixture adapter, not an operator of the candle flow itself: it
turns a stream of priced events into hourly OHLCV bars so that every later
stage has real input that grows with the data.  ``event_type`` plays the
symbol, ``value`` the trade price, and ``k + 1`` from the ``props`` JSON the
traded quantity; even ``k`` marks a taker buy.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_instant

BAR_INTERVAL = "1 hour"


def ticks(events: DataFrame, interval: str = BAR_INTERVAL) -> DataFrame:
    """Events as trades: symbol, the start of the bar, price, quantity, taker
    side and an order key that packs (ts, event_id) into one number, so that
    the first and last price of a bar come out of a hash aggregation."""
    k = F.from_json("props", "k string").getField("k").try_cast("int")
    q = k.cast("double") + F.lit(1.0)
    micros = F.unix_micros(as_instant(events, "ts")).cast("decimal(38,0)")
    key = micros * F.lit(Decimal(2**63)) + F.coalesce("event_id", F.lit(0)).cast("decimal(19,0)")
    return events.select(
        F.col("event_type").alias("symbol"),
        F.window("ts", interval).start.alias("open_time"),
        key.cast("decimal(38,0)").alias("_key"),
        F.col("value").alias("_price"),
        q.alias("_q"),
        (F.pmod(k, F.lit(2)) == F.lit(0)).alias("_taker"),
    )


def bar_parts(trades: DataFrame) -> DataFrame:
    """One row per (symbol, bar) with what :func:`merge_parts` can put
    together again from any division of the trades."""
    taken = F.when(F.col("_taker"), F.lit(1.0)).otherwise(F.lit(0.0))
    amount = F.col("_price") * F.col("_q")
    return trades.groupBy("symbol", "open_time").agg(
        F.min("_key").alias("first_key"),
        F.min_by("_price", "_key").alias("open"),
        F.max("_price").alias("high"),
        F.min("_price").alias("low"),
        F.max("_key").alias("last_key"),
        F.max_by("_price", "_key").alias("close"),
        F.sum("_q").alias("volume"),
        F.sum(amount).alias("quote_asset_volume"),
        F.count(F.lit(1)).alias("number_of_trades"),
        F.sum(F.when(F.col("_taker"), F.col("_q")).otherwise(F.lit(0.0))).alias("taker_buy_base_volume"),
        F.sum(F.when(F.col("_taker"), amount).otherwise(F.lit(0.0))).alias("taker_buy_quote_volume"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of bars, from several batches, put together."""
    sums = ("volume", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume")
    return parts.groupBy("symbol", "open_time").agg(
        F.min_by("open", "first_key").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_key").alias("close"),
        *[F.sum(c).alias(c) for c in sums],
    )


def finished(bars: DataFrame, interval: str = BAR_INTERVAL) -> DataFrame:
    """Bars with the silver candle columns."""
    close_time = F.col("open_time") + F.expr(f"INTERVAL {interval}") - F.expr("INTERVAL 1 MILLISECOND")
    return bars.select(
        "symbol",
        "open_time",
        "open",
        "high",
        "low",
        "close",
        "volume",
        close_time.alias("close_time"),
        F.round("quote_asset_volume", 4).alias("quote_asset_volume"),
        "number_of_trades",
        "taker_buy_base_volume",
        F.round("taker_buy_quote_volume", 4).alias("taker_buy_quote_volume"),
    )


def bars_from_events(events: DataFrame, interval: str = BAR_INTERVAL) -> DataFrame:
    """Aggregate events into bars with the silver candle columns.

    One hash aggregation with map-side partial aggregation, so a hot symbol or
    a hot hour is pre-aggregated in every task before the shuffle.
    ``open``/``close`` are the prices at the first/last (ts, event_id).
    """
    return finished(bar_parts(ticks(events, interval)), interval)
