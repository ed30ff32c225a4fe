import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candleflow.functions.columns import numeric_columns
from candleflow.operators.quality import correlation, null_counts, quantile, rows_with_null


def test_null_counts_and_rows_with_null(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, "a", 3.0), (3, "b", 4.0)], "a int, b string, c double")
    r = null_counts(df).first()
    assert (r.n_rows, r.nulls_a, r.nulls_b, r.nulls_c) == (3, 1, 1, 0)
    assert rows_with_null(df).count() == 2


@pytest.mark.parametrize("q", [0.1, 0.5, 0.9])
def test_exact_quantile_matches_discrete_rule(spark, q):
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 50)) for _ in range(501)] + [None, float("nan")]
    df = spark.createDataFrame([(("hot" if i % 2 else "c"), v) for i, v in enumerate(vals)], "g string, x double")
    got = quantile(df, "x", q, alias="m").first().m
    clean = sorted(v for v in vals if v is not None and not math.isnan(v))
    assert got == clean[max(1, math.ceil(q * len(clean))) - 1]
    per = {r.g: r.m for r in quantile(df, "x", q, partition_by=["g"], alias="m").collect()}
    for g in ("hot", "c"):
        xs = sorted(v for i, v in enumerate(vals) if (("hot" if i % 2 else "c") == g) and v is not None and not math.isnan(v))
        assert per[g] == xs[max(1, math.ceil(q * len(xs))) - 1]


def test_approx_quantile_is_bounded_sketch(spark):
    df = spark.range(0, 10001).select(F.col("id").cast("double").alias("x"))
    got = quantile(df, "x", 0.5, rel_err=0.01, alias="m").first().m
    assert abs(got - 5000) <= 0.01 * 10001


def test_correlation_matches_numpy(spark):
    rnd = np.random.default_rng(5)
    a = rnd.normal(size=300)
    b = 0.5 * a + rnd.normal(size=300)
    c = rnd.normal(size=300)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in correlation(df, ["a", "b", "c"]).collect()}
    m = np.corrcoef(np.vstack([a, b, c]))
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert abs(got[("a", "b")] - m[0, 1]) < 1e-9 and abs(got[("b", "c")] - m[1, 2]) < 1e-9


def test_numeric_columns_legacy_drops_bigint(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "x")], "a int, b bigint, c double, d string")
    assert numeric_columns(df) == ["a", "b", "c"]
    assert numeric_columns(df, legacy=True) == ["a", "c"]


def test_exact_quantile_with_a_hot_value(spark):
    # one value holds half of all rows; answer must still be exact
    vals = [42.0] * 3000 + [float(i) for i in range(3000)]
    df = spark.createDataFrame([(("a" if i % 3 else "b"), v) for i, v in enumerate(vals)], "g string, x double")
    for q in (0.1, 0.5, 0.75):
        got = quantile(df, "x", q, alias="m").first().m
        s = sorted(vals)
        assert got == s[math.floor((len(s) - 1) * q)]


def test_quantile_off_the_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    assert [quantile(df, "x", q, alias="m").first().m for q in (0.0, 0.1, 0.5, 0.9, 1.0)] == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_correlation_with_an_infinite_value_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, float("inf"), 1.0), (3.0, 1.0, 4.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in correlation(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["b", "c"] is None and got["a", "c"] is not None
