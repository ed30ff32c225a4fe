import random

import pytest
from pyspark.sql import functions as F

from candleflow.operators.observed import QualityCounts
from candleflow.operators.sketches import merge_sketches, quantile_rank_errors, rank_error, read_sketches, sketch_columns, sketch_quantiles, store_sketches
from candleflow.sinks.writers import write_parquet
from frames import frame, candle


def test_merged_sketches_keep_their_rank_error(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("hot").alias("symbol"), (F.col("id") % 50).alias("part"),
        F.pmod(F.xxhash64("id"), F.lit(10_000)).cast("double").alias("x"))
    merged = merge_sketches(sketch_columns(df, ["x"], ["symbol", "part"]), ["symbol"])
    answers = sketch_quantiles(merged, [0.0, 0.01, 0.5, 0.99, 1.0], ["symbol"])
    got = quantile_rank_errors(df, answers.persist(), ["symbol"]).collect()
    assert len(got) == 10 and {(r.symbol, r.n) for r in got} == {("a", 20_000), ("hot", 40_000)}
    assert all(r.off <= 2 * rank_error() for r in got)
    whole = sketch_quantiles(merge_sketches(merged), [0.5]).persist()
    r, = quantile_rank_errors(df, whole).collect()
    assert r.n == 60_000 and r.off <= 2 * rank_error()


def test_missing_values_and_empty_tables(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("b", None)]
    df = spark.createDataFrame(rows, "symbol string, x double")
    got = {(r.symbol, r.n, r.value) for r in sketch_quantiles(sketch_columns(df, ["x"], ["symbol"]), [0.5], ["symbol"]).collect()}
    assert got == {("a", 1, 1.0), ("b", 0, None)}
    assert sketch_columns(df.limit(0), ["x"], ["symbol"]).count() == 0


def test_a_day_written_again_replaces_its_sketches(spark, tmp_path):
    day = 24 * 60
    rows = [candle("S", d * day + m, float(random.Random(d * 100 + m).random())) for d in range(3) for m in range(40)]
    path = str(tmp_path / "sketches")
    df = frame(spark, rows)
    store_sketches(df, path, ["close", "volume"])
    store_sketches(df.where(F.to_date("open_time") == "2024-01-02").withColumn("close", F.lit(7.0)), path, ["close", "volume"])
    got = {r.sketch_day.day: (r.n, r.value) for r in sketch_quantiles(
        merge_sketches(read_sketches(spark, path), ["sketch_day"]), [0.5], ["sketch_day"]).where("column_name = 'close'").collect()}
    assert set(got) == {1, 2, 3} and got[2] == (40, 7.0) and all(n == 40 and v != 7.0 for d, (n, v) in got.items() if d != 2)
    total, = sketch_quantiles(merge_sketches(read_sketches(spark, path)), [0.5]).where("column_name = 'volume'").collect()
    assert (total.n, total.value) == (120, 10.0)


@pytest.mark.parametrize("parts", [[], ["symbol"]])
def test_counts_come_with_the_write(spark, tmp_path, parts):
    rows = [("A", 1.0, "x"), ("A", None, "y"), ("B", float("nan"), None), ("B", 4.0, "z")]
    df = spark.createDataFrame(rows, "symbol string, v double, `t.u` string").withColumnRenamed("t.u", "t")
    counter = QualityCounts()
    write_parquet(df.repartition(4), str(tmp_path / "t"), partition_by=parts, watch=counter.watch)
    assert counter.get() == {"n_rows": 4, "complete_rows": 2, "nulls_symbol": 0, "nulls_v": 1, "nulls_t": 1}
    empty = QualityCounts(["v"])
    write_parquet(df.limit(0), str(tmp_path / "e"), watch=empty.watch)
    assert empty.get()["n_rows"] == 0
