from pyspark.sql import functions as F

from candleflow.functions.columns import train_cutoff
from candleflow.operators.split import chrono_split, time_index, train_test
from frames import candle, frame, series


def test_split_10(spark):
    s = chrono_split(series(spark, range(1, 11)))
    train, test = train_test(s)
    assert train.count() == 8 and test.count() == 2
    assert train.agg(F.max("open_time")).first()[0] < test.agg(F.min("open_time")).first()[0]


def test_split_per_symbol_and_purge(spark):
    rows = [candle("A", m, 1.0 + m) for m in range(20)] + [candle("B", m, 5.0) for m in range(7)]
    s = chrono_split(frame(spark, rows))
    counts = {(r.symbol, r.split): r["count"] for r in s.groupBy("symbol", "split").count().collect()}
    assert counts == {("A", "train"): 16, ("A", "test"): 4, ("B", "train"): 5, ("B", "test"): 2}
    p = chrono_split(frame(spark, rows), purge=3)
    counts = {(r.symbol, r.split): r["count"] for r in p.groupBy("symbol", "split").count().collect()}
    assert counts[("A", "train")] == 13 and counts[("A", "test")] == 4


def test_cutoff_equals_python_int(spark):
    df = spark.range(0, 5000).select(train_cutoff(F.col("id")).alias("c"), F.col("id"))
    for r in df.collect():
        assert r.c == int(r.id * 0.8)


def test_time_index_is_global(spark):
    rows = [candle("B", m, 1.0) for m in range(5)] + [candle("A", m, 1.0) for m in range(5)]
    idx = time_index(frame(spark, rows)).orderBy("row_id").collect()
    assert [r.row_id for r in idx] == list(range(1, 11))
    assert [(r.open_time.minute, r.symbol) for r in idx][:2] == [(0, "A"), (0, "B")]


def test_layout_split_equals_index_split(spark):
    from candleflow.operators.features import LAYOUT_COLUMNS, features

    # zero volume in some rows: policy "all" drops them in the middle of series
    rows = [candle("A", m, 10.0 + (m % 7), volume=(0.0 if m % 9 == 4 else 10.0)) for m in range(60)]
    rows += [candle("B", m, 50.0 - (m % 5)) for m in range(45)]
    df = frame(spark, rows)
    with_layout = features(df, "all", block_rows=12, layout=True)
    assert set(LAYOUT_COLUMNS) <= set(with_layout.columns)
    a = chrono_split(with_layout)
    b = chrono_split(features(df, "all", block_rows=12))
    assert a.columns == b.columns
    key = lambda d: sorted((r.symbol, r.open_time, r.row_id, r.split) for r in d.collect())
    assert key(a) == key(b) and a.count() == 60 - 11 - 6 + 45 - 11
