import os
import tempfile

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from candleflow import schemas
from candleflow.operators.clean import to_silver
from candleflow.operators.features import features
from candleflow.operators.metrics import regression_metrics
from candleflow.operators import ml
from candleflow.operators.ml import assemble, compare_models, estimator, evened, fit, poisson_weight
from candleflow.operators.score import score, score_linear, to_predictions
from candleflow.operators.split import chrono_split, train_test
from candleflow.sinks.writers import save_model
from candleflow.sources.events import bars_from_events
from candleflow.sources.models import DamagedModelError, ModelInputsError, load_model, model_inputs
from frames import SF_SMALL


@pytest.fixture(scope="module")
def split(spark):
    bars = bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    s = chrono_split(features(to_silver(bars))).cache()
    yield s
    s.unpersist()


def test_lr_matches_least_squares(spark, split):
    train, test = train_test(split)
    model = fit(train, "lr")
    got = score(test, model).select("symbol", "open_time", "prediction").toPandas()
    tr = train.select(*schemas.MODEL_INPUTS, schemas.LABEL).toPandas()
    X = np.column_stack([np.ones(len(tr)), tr[list(schemas.MODEL_INPUTS)].to_numpy(dtype=float)])
    beta, *_ = np.linalg.lstsq(X, tr[schemas.LABEL].to_numpy(dtype=float), rcond=None)
    te = test.select("symbol", "open_time", *schemas.MODEL_INPUTS).toPandas()
    Xt = np.column_stack([np.ones(len(te)), te[list(schemas.MODEL_INPUTS)].to_numpy(dtype=float)])
    want = te.assign(want=Xt @ beta)
    m = got.merge(want, on=["symbol", "open_time"])
    assert len(m) == len(te) > 0
    assert np.allclose(m.prediction, m.want, rtol=1e-6, atol=1e-4)


def test_one_pass_metrics_equal_evaluator(spark, split):
    train, test = train_test(split)
    pred = fit(train, "lr").transform(test)
    ours = {r.metric: r.value for r in regression_metrics(pred).collect()}
    for m in schemas.METRICS:
        ev = RegressionEvaluator(labelCol=schemas.LABEL, predictionCol="prediction", metricName=m).evaluate(pred)
        assert abs(ours[m] - ev) < 1e-9 * max(1.0, abs(ev))


def test_save_load_and_bare_model_fallback(spark, split):
    train, test = train_test(split)
    model = fit(train, "lr")
    d = tempfile.mkdtemp(prefix="models-", dir="/tmp")
    save_model(model, f"{d}/pipe")
    bare = estimator("lr").fit(assemble(train))
    save_model(bare, f"{d}/bare")
    a = score(test, load_model(f"{d}/pipe")).select("prediction").toPandas()
    b = score(test, load_model(f"{d}/bare")).select("prediction").toPandas()
    assert np.allclose(a.prediction, b.prediction, rtol=1e-9)
    assert load_model(f"{d}/missing") is None
    with pytest.raises(RuntimeError):
        score(test, None)


def test_missing_input_is_an_error(spark, split):
    _, test = train_test(split)
    with pytest.raises(ValueError):
        score(test.drop("taker_ratio"), load_model("/nonexistent") or fit(test, "lr"))
    with pytest.raises(ValueError):
        score_linear(test.drop("ma_5"), {"ma_5": 1.0}, 0.0)


def test_score_payload_row_in_double(spark, split):
    train, _ = train_test(split)
    model = fit(train, "lr")
    row = spark.createDataFrame(
        [("2026-01-23 15:00:00", 0.005, 50000.0, 49500.0, 1200.0, 49800.0, 150, 0.7)],
        "timestamp string, return_1m double, ma_5 double, ma_10 double, volume double, "
        "close_prev double, number_of_trades bigint, taker_ratio double",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = to_predictions(score(row, model), time_col="timestamp", key_cols=()).collect()
    assert len(out) == 1 and isinstance(out[0].predicted_price, float)
    assert [f.name for f in schemas.PREDICTION.fields] == out[0].__fields__[:4]


def test_tree_models_fit(spark, split):
    train, test = train_test(split)
    for fam in ("gbt", "rf"):
        m = fit(train, fam, maxIter=5) if fam == "gbt" else fit(train, fam, numTrees=5)
        assert score(test, m).where(F.col("prediction").isNull()).count() == 0


def test_invalid_rows_follow_the_chosen_policy(spark, split):
    train, test = train_test(split)
    model = fit(train, "lr")
    bad = test.limit(3).withColumn("taker_ratio", F.lit(None).cast("double"))
    assert score(bad, model, handle_invalid="skip").count() == 0
    kept = score(bad, model, handle_invalid="keep").collect()
    assert len(kept) == 3
    with pytest.raises(Exception):
        score(bad, model, handle_invalid="error").collect()


def test_forest_does_not_depend_on_the_layout(spark, split):
    """The same splits at 1, 4, 16 and 40 partitions, and in other orders."""
    train, test = train_test(split)
    train = train.cache()
    seen = []
    for rows in (train.coalesce(1), train.repartition(4), train.repartition(16, "close").sortWithinPartitions("volume"), train.repartition(40)):
        model = fit(rows, "rf", numTrees=4, maxDepth=5)
        scored = score(test, model).select("symbol", "open_time", "prediction").collect()
        splits = [line.split("Predict")[0] for line in model.stages[-1].toDebugString.splitlines()[1:]]
        seen.append((splits, {(r.symbol, r.open_time): r.prediction for r in scored}))
    for splits, scored in seen[1:]:
        assert splits == seen[0][0] and scored.keys() == seen[0][1].keys()
        assert all(abs(scored[k] - v) < 1e-9 * max(1, abs(v)) for k, v in seen[0][1].items())
    d = tempfile.mkdtemp(prefix="forest-", dir="/tmp")
    save_model(model, d)
    again = {(r.symbol, r.open_time): r.prediction for r in score(test, load_model(d)).collect()}
    assert again == seen[-1][1] and load_model(d).stages[-1].getNumTrees == 4


def test_forest_learns_and_takes_odd_inputs(spark):
    rows = spark.range(3000).selectExpr("'S' as symbol", "id as open_time", "cast(id % 97 as double) as a", "7.0D as b", "cast(null as double) as c",
                                        "if(id % 97 < 40, 5.0D, 1.0D) as y")
    model = fit(rows.fillna(0.0, ["c"]), "rf", inputs=["a", "b", "c"], label_col="y", numTrees=7, maxDepth=3, featureSubsetStrategy="all")
    got = model.transform(rows.fillna(0.0, ["c"])).selectExpr("avg(abs(prediction - y)) as e").first().e
    assert got < 0.2
    assert score(rows, model, inputs=["a", "b", "c"], handle_invalid="skip").count() == 0
    assert score(rows, model, inputs=["a", "b", "c"], handle_invalid="keep").count() == 3000


def test_bags_are_poisson(spark):
    rows = spark.range(40_000).select(*[poisson_weight(["id"], t, 42).alias(f"w{t}") for t in (0, 1)])
    r = rows.selectExpr("avg(w0) as m", "var_pop(w0) as v", "avg(if(w0 = 0, 1, 0)) as z", "corr(w0, w1) as c").first()
    assert abs(r.m - 1) < 0.03 and abs(r.v - 1) < 0.05 and abs(r.z - 0.3679) < 0.01 and abs(r.c) < 0.02


def test_compare_models_matches_the_evaluator(spark, split):
    train, test = train_test(split)
    got = {(r.model, r.metric): r.value for r in compare_models(train, test, families=("lr", "rf")).collect()}
    for family in ("lr", "rf"):
        scored = score(test, fit(train, family))
        for metric in ("rmse", "mae", "r2"):
            want = RegressionEvaluator(labelCol=schemas.LABEL, metricName=metric).evaluate(scored)
            assert abs(got[family, metric] - want) < 1e-6 * max(1, abs(want))


def test_gbt_matches_sparks_own_estimator(spark, split):
    train, test = train_test(split)
    ours = score(test, fit(train, "gbt", maxIter=4)).select("prediction").toPandas()
    rows = assemble(train)
    own = GBTRegressor(labelCol=schemas.LABEL, featuresCol="features", **{**schemas.GBT_PARAMS, "maxIter": 4}).fit(rows)
    want = own.transform(assemble(test)).select("prediction").toPandas()
    assert abs(sorted(ours.prediction)[5] - sorted(want.prediction)[5]) < 1e-9 and abs(ours.prediction.sum() - want.prediction.sum()) < 1e-6


def test_a_model_that_is_there_but_wrong_says_so(spark, split):
    train, _ = train_test(split)
    d = tempfile.mkdtemp(prefix="models-wrong-", dir="/tmp")
    save_model(fit(train, "lr", inputs=["ma_5", "volume"]), f"{d}/two")
    save_model(estimator("lr").fit(assemble(train, ["ma_5"])), f"{d}/bare")
    save_model(fit(train, "rf", numTrees=2, maxDepth=2), f"{d}/forest")
    assert load_model(f"{d}/nothing") is None
    assert model_inputs(load_model(f"{d}/two", inputs=None)) == ["ma_5", "volume"]
    assert model_inputs(load_model(f"{d}/forest")) == list(schemas.MODEL_INPUTS)
    for path, inputs in ((f"{d}/two", schemas.MODEL_INPUTS), (f"{d}/two", ["volume", "ma_5"]), (f"{d}/bare", schemas.MODEL_INPUTS)):
        with pytest.raises(ModelInputsError):
            load_model(path, inputs)
    assert load_model(f"{d}/two", ["ma_5", "volume"]) is not None and load_model(f"{d}/bare", ["ma_5"]) is not None
    for part in os.listdir(f"{d}/two/stages/{sorted(os.listdir(f'{d}/two/stages'))[-1]}/data"):
        with open(f"{d}/two/stages/{sorted(os.listdir(f'{d}/two/stages'))[-1]}/data/{part}", "wb"):
            pass
    os.makedirs(f"{d}/empty")
    for path in (f"{d}/two", f"{d}/empty"):
        with pytest.raises(DamagedModelError):
            load_model(path, inputs=None)


def test_fits_of_many_passes_read_even_partitions(spark, split, monkeypatch):
    """As many tasks as the rows ask for, whatever partitions they come in."""
    train, test = train_test(split)
    wide = train.repartition(64, "symbol")  # a partition per symbol, the others empty
    seen, real = [], ml._fit_prepared
    monkeypatch.setattr(ml, "_fit_prepared", lambda rows, family, *a, **k: seen.append((family, rows.rdd.getNumPartitions(), rows.count())) or real(rows, family, *a, **k))
    assert compare_models(wide, test, families=("lr",)).count() == 3
    fit(wide, "gbt", maxIter=1, maxDepth=1)
    n = train.where(f"{schemas.LABEL} is not null").count()
    assert seen == [("lr", 1, n), ("gbt", 1, n)]


def test_evened_rows_are_all_there_in_an_order_of_their_own(spark):
    rows = spark.createDataFrame([(k % 7 or None, float(k % 50)) for k in range(1000)], "a int, x double")
    held = []
    for layout in (rows.coalesce(1), rows.repartition(30, "a"), rows.repartition(5)):
        with evened(layout, rows_per_task=100) as even:
            parts = [[tuple(r) for r in part] for part in even.rdd.glom().collect()]
        assert len(parts) == 10 and max(map(len, parts)) < 300
        held.append(parts)
    assert held[0] == held[1] == held[2]
    assert sorted(map(repr, sum(held[0], []))) == sorted(repr(tuple(r)) for r in rows.collect())
    with evened(rows.where("false")) as even:
        assert even.count() == 0
