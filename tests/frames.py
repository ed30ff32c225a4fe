"""Hand-made candle frames (see FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from candleflow import schemas

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)

SILVER = T.StructType([f for f in schemas.BRONZE.fields if f.name != "ignore"])


def candle(symbol, minute, close, volume=10.0, taker=4.0, trades=5):
    t = T0 + dt.timedelta(minutes=minute)
    return (
        symbol,
        t,
        close,
        close + 1.0,
        close - 1.0,
        close,
        volume,
        t + dt.timedelta(seconds=59, milliseconds=999),
        close * volume,
        trades,
        taker,
        close * taker,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def series(spark, closes, symbol="S", start=0, minutes=None):
    mins = minutes if minutes is not None else list(range(start, start + len(closes)))
    return frame(spark, [candle(symbol, m, float(c)) for m, c in zip(mins, closes)])
