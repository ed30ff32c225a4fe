import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candleflow.operators.sequence import block_window, ordered_index


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one key holds about a third of all rows
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}"
        rows.append((key, i * 7 % n, float(rnd.random())))
    return spark.createDataFrame(rows, "key string, t long, v double")


@pytest.mark.parametrize("parts", [7, None])
def test_ordered_index_matches_row_number(spark, parts):
    df = _skewed(spark)
    got = ordered_index(df, ["t"], ["key"], "rid", "n", num_partitions=parts).toPandas()
    want = df.withColumn("rid", F.row_number().over(Window.partitionBy("key").orderBy("t"))).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("key"))
    ).toPandas()
    m = got.merge(want, on=["key", "t"], suffixes=("_g", "_w"))
    assert len(m) == len(want) == len(got)
    assert (m.rid_g == m.rid_w).all()
    assert (m.n_g == m.n_w).all()


def test_ordered_index_global_and_null_keys(spark):
    df = spark.createDataFrame([(None, 3), ("a", 1), (None, 1), ("a", 2), ("b", 5)], "key string, t int")
    got = ordered_index(df, ["t"], ["key"], "rid", num_partitions=3).toPandas()
    assert sorted(got[got.key.isna()].rid) == [1, 2]
    glob = ordered_index(df, ["t", "key"], [], "rid", num_partitions=4).orderBy("rid").toPandas()
    assert list(glob.rid) == [1, 2, 3, 4, 5]
    assert list(glob.t) == sorted(glob.t)


@pytest.mark.parametrize("block", [10, 11, 17, 100000])
def test_block_window_equals_plain_window(spark, block):
    df = _skewed(spark, n=800)
    idx = ordered_index(df, ["t"], ["key"], "rid", num_partitions=5)

    def cols(w):
        return {
            "lead10": F.lead("v", 10).over(w),
            "lag1": F.lag("v", 1).over(w),
            "ma10": F.avg("v").over(w.rowsBetween(-9, 0)),
        }

    got = block_window(idx, ["key"], "rid", cols, behind=9, ahead=10, block_rows=block).toPandas()
    w = Window.partitionBy("key").orderBy("t")
    want = df.select("*", *[c.alias(n) for n, c in cols(w).items()]).toPandas()
    m = got.merge(want, on=["key", "t"], suffixes=("_g", "_w"))
    assert len(m) == len(want) == len(got)
    for c in ("lead10", "lag1", "ma10"):
        a, b = m[f"{c}_g"], m[f"{c}_w"]
        assert ((a - b).abs().fillna(0) < 1e-12).all() and (a.isna() == b.isna()).all(), c


def test_block_window_rejects_small_blocks(spark):
    df = spark.createDataFrame([(1, 1.0)], "rid long, v double")
    with pytest.raises(ValueError):
        block_window(df, [], "rid", lambda w: {"x": F.lead("v", 10).over(w)}, 0, 10, block_rows=5)


def test_hot_series_is_spread_over_tasks(spark):
    # one symbol holds 90 % of the rows; neither the index nor the block
    # window may put that symbol in one task
    rows = [("hot" if i % 10 else f"s{i % 7}", i, float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "key string, t long, v double")
    idx = ordered_index(df, ["t"], ["key"], "rid", num_partitions=8)
    per_task = idx.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("key") == "hot").alias("n"))
    sizes = [r.n for r in per_task.collect()]
    assert max(sizes) < 0.5 * 5400 and sum(1 for s in sizes if s > 0) >= 4
    win = block_window(idx, ["key"], "rid", lambda w: {"x": F.lag("v", 1).over(w)}, 1, 1, block_rows=200)
    per_task = win.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("key") == "hot").alias("n"))
    sizes = [r.n for r in per_task.collect()]
    assert sum(sizes) == 5400 and max(sizes) < 0.5 * 5400


def test_equal_order_values_are_spread(spark):
    # half of all rows share one value of the order column (rows differ in id)
    rows = [(i, 7.0 if i % 2 else float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, x double")
    idx = ordered_index(df, ["x"], [], "rid", num_partitions=8)
    per_task = idx.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("x") == 7.0).alias("n"))
    sizes = [r.n for r in per_task.collect()]
    assert sum(sizes) == 2000 and max(sizes) < 1500
    got = idx.orderBy("rid").select("x").toPandas().x.tolist()
    assert got == sorted(x for _, x in rows)


def test_bounded_broadcast_falls_back_above_the_limit(spark):
    from candleflow.plans.sizing import bounded_broadcast

    big = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = spark.range(0, 1000, 3).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    hinted = bounded_broadcast(small)
    plain = bounded_broadcast(small, byte_limit=0)
    a = sorted(tuple(r) for r in big.join(hinted, "k").collect())
    b = sorted(tuple(r) for r in big.join(plain, "k").collect())
    assert a == b and len(a) == 334
    assert "BroadcastHashJoin" in big.join(hinted, "k")._jdf.queryExecution().executedPlan().toString()
