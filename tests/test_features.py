import math

import pytest
from pyspark.sql import functions as F

from candleflow import schemas
from candleflow.operators.clean import drop_missing
from candleflow.operators.features import add_features, features
from frames import candle, frame, series


def test_series_12_gives_one_row(spark):
    out = features(series(spark, range(1, 13))).collect()
    assert len(out) == 1
    r = out[0]
    assert r.close == 2.0 and r.close_prev == 1.0 and r.close_t_plus_10 == 12.0
    assert r.ma_5 == 1.5 and r.ma_10 == 1.5 and r.return_1m == 1.0


def test_series_11_is_too_short(spark):
    assert features(series(spark, range(1, 12))).count() == 0


def test_head_frames_are_partial(spark):
    raw = add_features(series(spark, range(1, 21))).orderBy("open_time").collect()
    assert raw[0].ma_5 == 1.0 and raw[0].close_prev is None and raw[0].return_1m is None
    assert raw[3].ma_5 == 2.5 and raw[6].ma_5 == 5.0 and raw[12].ma_10 == 8.5
    assert raw[9].close_t_plus_10 == 20.0 and raw[10].close_t_plus_10 is None


def test_gap_counts_rows_not_minutes(spark):
    minutes = [0, 1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]  # minute 3 is missing
    df = series(spark, range(1, 14), minutes=minutes)
    first = add_features(df).orderBy("open_time").first()
    assert first.close_t_plus_10 == 11.0  # 10 rows ahead = 11 minutes ahead


def test_two_symbols_do_not_leak(spark):
    a = [candle("A", m, 100.0 + m) for m in range(15)]
    b = [candle("B", m, 1000.0 + m) for m in range(15)]
    rows = [r for pair in zip(a, b) for r in pair]
    out = features(frame(spark, rows)).toPandas()
    assert len(out) == 2 * (15 - 11)
    for sym, base in (("A", 100.0), ("B", 1000.0)):
        part = out[out.symbol == sym]
        assert (part.close_prev >= base).all() and (part.close_t_plus_10 < base + 100).all()


def test_zero_volume_gives_null_ratio(spark):
    rows = [candle("Z", m, 10.0 + m, volume=(0.0 if m == 5 else 10.0)) for m in range(20)]
    raw = add_features(frame(spark, rows))
    zero = raw.where(F.col("volume") == 0).first()
    assert zero.taker_ratio is None
    assert drop_missing(raw, "label_return").where(F.col("volume") == 0).count() == 1
    assert drop_missing(raw, "all").where(F.col("volume") == 0).count() == 0
    assert drop_missing(raw, "derived").where(F.col("volume") == 0).count() == 0


def test_nan_close_policy(spark):
    rows = [candle("N", m, float("nan") if m == 15 else 10.0 + m) for m in range(30)]
    raw = add_features(frame(spark, rows))
    assert raw.dropna().where(F.isnan("close")).count() == 0
    assert raw.where(F.col("close").isNotNull() & F.isnan("close")).count() == 1


def test_zero_previous_close_gives_null_return(spark):
    rows = [candle("P", m, 0.0 if m == 3 else 5.0) for m in range(20)]
    r = add_features(frame(spark, rows)).where(F.col("open_time") == F.lit(rows[4][1])).first()
    assert r.close_prev == 0.0 and r.return_1m is None


def test_rows_per_symbol_and_frame_bounds(spark):
    from candleflow.sources.events import bars_from_events

    bars = bars_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    f = features(bars, block_rows=13)
    per_bars = {r.symbol: r["count"] for r in bars.groupBy("symbol").count().collect()}
    per_feat = {r.symbol: r["count"] for r in f.groupBy("symbol").count().collect()}
    assert per_feat == {s: n - 11 for s, n in per_bars.items()}
    default = features(bars).toPandas().sort_values(["symbol", "open_time"]).reset_index(drop=True)
    small = f.toPandas().sort_values(["symbol", "open_time"]).reset_index(drop=True)
    assert default.equals(small)
    again = features(bars.repartition(5, "open_time")).toPandas()
    assert len(again) == len(default)


def test_feature_columns_in_order(spark):
    out = features(series(spark, range(1, 30)))
    assert tuple(out.columns) == schemas.FEATURE_COLUMNS


def test_empty_input_gives_empty_output(spark):
    empty = frame(spark, [])
    assert features(empty).count() == 0
    from candleflow.operators.split import chrono_split, time_index

    assert chrono_split(empty).count() == 0 and time_index(empty).count() == 0


def test_moving_averages_lie_within_their_frames(spark):
    from pyspark.sql import Window

    from candleflow.sources.events import bars_from_events

    bars = bars_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    raw = add_features(bars, block_rows=17)
    w = Window.partitionBy("symbol").orderBy("open_time")
    checked = raw.select(
        "ma_5",
        "ma_10",
        F.min("close").over(w.rowsBetween(-4, 0)).alias("lo5"),
        F.max("close").over(w.rowsBetween(-4, 0)).alias("hi5"),
        F.min("close").over(w.rowsBetween(-9, 0)).alias("lo10"),
        F.max("close").over(w.rowsBetween(-9, 0)).alias("hi10"),
    )
    bad = checked.where(
        (F.col("ma_5") < F.col("lo5") - 1e-9)
        | (F.col("ma_5") > F.col("hi5") + 1e-9)
        | (F.col("ma_10") < F.col("lo10") - 1e-9)
        | (F.col("ma_10") > F.col("hi10") + 1e-9)
    )
    assert bad.count() == 0 and checked.where(F.col("ma_10").isNull()).count() == 0
