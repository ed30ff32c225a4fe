import datetime as dt
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candleflow import schemas
from candleflow.operators.metrics import regression_metrics
from candleflow.plans.refresh import run_refresh, score_table
from candleflow.sinks import versions
from candleflow.sinks.versions import new_version, publish, release_versions
from candleflow.sinks.writers import append_metrics, append_predictions, read_runs, write_kline_bodies, write_parquet
from candleflow.sources.events import bars_from_events
from candleflow.sources.tables import EmptyInputError, read_nanos_parquet, read_table
from frames import SF_SMALL


def _tmp(prefix):
    return tempfile.mkdtemp(prefix=prefix, dir="/tmp")


def test_dynamic_partition_overwrite_keeps_other_symbols(spark):
    d = _tmp("parts-")
    df = spark.createDataFrame([("A", 1), ("B", 2)], "symbol string, x int")
    write_parquet(df, d, partition_by=["symbol"])
    write_parquet(spark.createDataFrame([("A", 9)], "symbol string, x int"), d, partition_by=["symbol"])
    got = {(r.symbol, r.x) for r in spark.read.parquet(d).collect()}
    assert got == {("A", 9), ("B", 2)}


def test_read_table_options_and_empty_guard(spark):
    d = _tmp("empty-")
    spark.createDataFrame([], "x int").write.mode("overwrite").parquet(d)
    with pytest.raises(EmptyInputError):
        read_table(spark, d, require_rows=True)
    assert read_table(spark, f"{SF_SMALL}/region.parquet", legacy_calendar=True).count() == 5
    with pytest.raises(Exception):
        read_table(spark, "/nonexistent/path").count()


def test_nanosecond_parquet(spark):
    d = _tmp("nanos-")
    t = pa.table({"open_time": pa.array([1_700_000_000_123_456_789], type=pa.timestamp("ns")), "x": [1]})
    pq.write_table(t, f"{d}/f.parquet")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        df = read_nanos_parquet(spark, d, ["open_time"])
        us = df.select(F.unix_micros("open_time").alias("us")).first().us
        assert us == 1_700_000_000_123_456
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    with pytest.raises(RuntimeError):
        read_nanos_parquet(spark, d, ["open_time"])


def test_metric_and_prediction_appends(spark):
    d = _tmp("appends-")
    pred = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5)], "close_t_plus_10 double, prediction double")
    m = regression_metrics(pred, model="const")
    append_metrics(m, f"{d}/metrics", "run1")
    append_metrics(m, f"{d}/metrics", "run2")
    assert spark.read.parquet(f"{d}/metrics").count() == 6
    rec = spark.createDataFrame(
        [("1", dt.datetime(2024, 1, 1), 10.0, dt.datetime(2024, 1, 2))],
        "id string, market_time timestamp, predicted_price double, created_at timestamp",
    )
    append_predictions(rec, f"{d}/pred")
    append_predictions(rec, f"{d}/pred")
    assert spark.read.parquet(f"{d}/pred").columns[:4] == [f.name for f in schemas.PREDICTION.fields]


def test_refresh_from_landed_files(spark):
    d = _tmp("refresh-")
    bars = bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    write_kline_bodies(bars, f"{d}/landed")
    out = run_refresh(spark, f"{d}/landed", f"{d}/out", families=("lr",), run_id="r1")
    rows = {(r.model, r.metric) for r in out.collect()}
    assert rows == {("lr", "rmse"), ("lr", "mae"), ("lr", "r2")}
    feats = read_table(spark, f"{d}/out/features")
    assert feats.count() == bars.count() - 11 * bars.select("symbol").distinct().count()
    assert "symbol" in feats.columns
    from candleflow.sources.models import load_model

    assert load_model(f"{d}/out/models/lr") is not None


def test_refresh_is_idempotent(spark):
    d = _tmp("refresh2-")
    bars = bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    first = run_refresh(spark, bars, f"{d}/out", families=("lr",), run_id="a")
    n_feat = read_table(spark, f"{d}/out/features").count()
    n_pred = read_table(spark, f"{d}/out/test_predictions").count()
    second = run_refresh(spark, bars, f"{d}/out", families=("lr",), run_id="b")
    assert read_table(spark, f"{d}/out/features").count() == n_feat
    assert read_table(spark, f"{d}/out/test_predictions").count() == n_pred
    a = {(r.metric, round(r.value, 9)) for r in first.collect()}
    b = {(r.metric, round(r.value, 9)) for r in second.collect()}
    assert a == b and spark.read.parquet(f"{d}/out/metrics").count() == 6


def test_release_scratch_removes_only_our_folders(spark):
    import os

    from candleflow.session import materialize, release_scratch, scratch_path

    df = materialize(spark.range(5), "probe")
    assert df.count() == 5
    path = scratch_path(spark, "probe2")
    spark.range(3).write.parquet(path)
    local = path.replace("file:", "")
    assert os.path.exists(local)
    assert release_scratch(spark) >= 2
    assert not os.path.exists(local)
    assert release_scratch(spark) == 0


def test_refresh_replaces_whole_tables(spark):
    d = _tmp("refresh3-")
    bars = bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    names = sorted(r.symbol for r in bars.select("symbol").distinct().collect())
    seven = bars.where(bars.symbol == names[0])
    both = seven.withColumn("symbol", F.lit("007")).unionByName(seven.withColumn("symbol", F.lit("7")))
    run_refresh(spark, both, f"{d}/out", families=("lr",))
    feats = read_table(spark, f"{d}/out/features", text_columns=["symbol"])
    counts = {r.symbol: r["count"] for r in feats.groupBy("symbol").count().collect()}
    assert counts.keys() == {"007", "7"} and len(set(counts.values())) == 1
    metrics = run_refresh(spark, seven, f"{d}/out", families=("lr",))
    assert metrics.count() == 3  # this run's, though no run id was given
    assert [r.symbol for r in read_table(spark, f"{d}/out/silver").select("symbol").distinct().collect()] == [names[0]]


def test_refresh_of_nothing_says_so(spark):
    d = _tmp("refresh4-")
    bars = bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    with pytest.raises(EmptyInputError):
        run_refresh(spark, bars.limit(0), f"{d}/out")


def test_score_table_scores_every_row(spark):
    d = _tmp("score-")
    bars = bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    run_refresh(spark, bars, f"{d}/out", families=("lr",))
    feats = spark.read.parquet(f"{d}/out/features").withColumn("ma_5", F.when(F.col("close") > 50, F.col("ma_5")))
    out = score_table(spark, f"{d}/out/models/lr", feats, f"{d}/records")
    assert out.count() == feats.count() == spark.read.parquet(f"{d}/records").select("id").distinct().count()


def test_a_run_repeated_under_its_id_replaces_its_records(spark):
    d = _tmp("runs-")
    rec = spark.createDataFrame([("a", "007", 1.5)], "id string, symbol string, predicted_price double").selectExpr(
        "id", "timestamp'2024-01-01 00:00:00' as market_time", "predicted_price", "current_timestamp() as created_at", "symbol")
    two = rec.unionByName(rec.withColumn("id", F.lit("b")))
    for run, rows in (("1", two), ("2", rec), ("1", rec.withColumn("predicted_price", F.lit(2.5)))):
        assert append_predictions(rows, f"{d}/p", run_id=run) == run
    got = sorted((r.run_id, r.id, r.symbol, r.predicted_price) for r in read_runs(spark, f"{d}/p").collect())
    assert got == [("1", "a", "007", 2.5), ("2", "a", "007", 1.5)]
    append_predictions(rec, f"{d}/p")
    assert read_runs(spark, f"{d}/p").count() == 3 and read_runs(spark, f"{d}/p", "2").count() == 1
    with pytest.raises(ValueError):
        append_predictions(rec, f"{d}/p", run_id="a/b")


def test_a_lost_run_leaves_the_table_as_it_was(spark):
    d = _tmp("runs-lost-")
    m = spark.createDataFrame([("lr", "rmse", 1.0)], "model string, metric string, value double")
    append_metrics(m, f"{d}/m", "r1")
    with pytest.raises(Exception, match="lost"):
        append_metrics(m.withColumn("value", F.raise_error(F.lit("lost")).cast("double")), f"{d}/m", "r1")
    assert [(r.run_id, r.value) for r in read_runs(spark, f"{d}/m").collect()] == [("r1", 1.0)]


def test_a_replacement_lost_midway_leaves_the_old_table(spark):
    d = f"{_tmp('versions-')}/t"
    old = spark.createDataFrame([("007", 1), ("1e3", 2)], "symbol string, x int")
    publish(old, d, ["symbol"])
    read = lambda: sorted(tuple(r) for r in read_table(spark, d, text_columns=["symbol"]).select("symbol", "x").collect())
    assert read() == [("007", 1), ("1e3", 2)]
    half = spark.range(8, numPartitions=4).select(F.lit("A").alias("symbol"), F.when(F.col("id") < 6, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).cast("int").alias("x"))
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            publish(half, d)
        assert read() == [("007", 1), ("1e3", 2)]
    with pytest.raises(RuntimeError), new_version(spark, d) as path:  # killed after the files, before the mark
        old.write.parquet(path)
        raise RuntimeError
    assert read() == [("007", 1), ("1e3", 2)]
    planned = read_table(spark, d, text_columns=["symbol"])
    publish(old.where("x = 2"), d, ["symbol"])
    assert read() == [("1e3", 2)]
    assert planned.count() == 2  # a reader of the version before goes on
    assert release_versions(spark, d) == 4  # the old one and three left-overs
    assert read() == [("1e3", 2)]
    assert len(versions.published(spark, d)) == 1
    with pytest.raises(ValueError):
        release_versions(spark, d, keep=0)
    with pytest.raises(ValueError), new_version(spark, d, 1):
        pass


def test_tables_without_versions_read_as_before(spark):
    d = _tmp("plain-")
    write_parquet(spark.createDataFrame([("007", 1)], "symbol string, x int"), d, partition_by=["symbol"])
    assert read_table(spark, d).first().symbol == 7
    assert read_table(spark, d, text_columns=["symbol"]).first().symbol == "007"
