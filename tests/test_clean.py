import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from candleflow.operators.clean import dedup_keep_first, dedup_rows, latest_n, sample_rows, to_silver
from candleflow.operators.quality import duplicate_report
from frames import SILVER, candle, frame


def _bronze(spark, rows):
    return spark.createDataFrame([(*r, "0") for r in rows], "{}, ignore string".format(SILVER.simpleString()[7:-1]))


def test_complete_copies_win_by_default(spark):
    good = candle("S", 0, 10.0)
    bad = list(candle("S", 0, 10.0))
    bad[5] = None  # NULL close
    other = candle("S", 1, 11.0)
    df = _bronze(spark, [good, tuple(bad), other])
    lost = to_silver(df.withColumn("number_of_trades", F.when(F.col("close").isNull(), 10**6).otherwise(F.col("number_of_trades"))), complete_first=False)
    assert [r.open_time.minute for r in lost.collect()] == [1]
    kept = to_silver(df).orderBy("open_time").collect()
    assert [r.open_time.minute for r in kept] == [0, 1]
    assert "ignore" not in to_silver(df).columns


def test_dedup_first_and_last_match_brute_force(spark):
    rows = [(k % 7, (k * 13) % 5, float(k % 3), f"x{k % 4}") for k in range(200)]
    df = spark.createDataFrame(rows, "k int, o int, v double, s string")
    pdf = pd.DataFrame(rows, columns=["k", "o", "v", "s"])
    first = dedup_keep_first(df, ["k"], ["o"]).toPandas().sort_values("k").reset_index(drop=True)
    want = pdf.sort_values(["k", "o", "v", "s"]).groupby("k").head(1).sort_values("k").reset_index(drop=True)
    assert first.values.tolist() == want.values.tolist()
    last = dedup_keep_first(df, ["k"], ["o"], keep="last").toPandas().sort_values("k").reset_index(drop=True)
    want = pdf.sort_values(["k", "o", "v", "s"]).groupby("k").tail(1).sort_values("k").reset_index(drop=True)
    assert last.values.tolist() == want.values.tolist()


def test_dedup_hot_key_is_partially_aggregated(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = dedup_keep_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert sorted(r.v for r in dedup_keep_first(df, ["k"], ["v"]).collect()) == [0, 1]


def test_full_row_distinct_and_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c")], "k int, s string")
    assert dedup_rows(df).count() == 3
    r = duplicate_report(df).first()
    assert (r.total_rows, r.distinct_rows, r.duplicate_rows) == (4, 3, 1)
    r = duplicate_report(df, ["k"]).first()
    assert (r.total_rows, r.distinct_rows, r.duplicate_rows) == (4, 2, 2)


def test_latest_n_matches_brute_force(spark):
    rows = [("hot" if i % 3 else f"s{i % 5}", i, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "symbol string, open_time long, v double").repartition(9)
    got = latest_n(df, 25, salt_buckets=4).toPandas()
    pdf = pd.DataFrame(rows, columns=["symbol", "open_time", "v"])
    want = pdf.sort_values("open_time", ascending=False).groupby("symbol").head(25)
    key = lambda d: sorted(zip(d.symbol, d.open_time))
    assert key(got) == key(want)


def test_sample_is_stable_under_repartition(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("k"))
    a = {r.k for r in sample_rows(df, 0.1, ["k"]).collect()}
    b = {r.k for r in sample_rows(df.repartition(7), 0.1, ["k"]).collect()}
    assert a == b and 120 < len(a) < 280


def test_silver_keeps_the_newest_copy(spark):
    old, new = list(candle("S", 0, 100.0)), list(candle("S", 0, 101.0))
    t = SILVER.fieldNames().index("number_of_trades")
    old[t], new[t] = 3, 90
    df = _bronze(spark, [tuple(old), tuple(new)])
    assert [r.close for r in to_silver(df).collect()] == [101.0]
    polled = df.withColumn("polled", F.when(F.col("number_of_trades") == 3, 2).otherwise(1))
    out = to_silver(polled, poll_col="polled")
    assert [r.close for r in out.collect()] == [100.0] and "polled" not in out.columns
