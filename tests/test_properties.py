"""Randomised checks of the core operators against plain pandas."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candleflow.operators.clean import dedup_keep_first, latest_n
from candleflow.operators.sequence import block_window, ordered_index

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), st.integers(0, 60), st.floats(-5, 5)),
    min_size=1,
    max_size=120,
)


def _unique_time(rows):
    seen, out = set(), []
    for k, t, v in rows:
        if (k, t) not in seen:
            seen.add((k, t))
            out.append((k, t, v))
    return out


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 9))
def test_ordered_index_property(spark, rows, parts):
    rows = _unique_time(rows)
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = ordered_index(df, ["t"], ["k"], "rid", "n", num_partitions=parts).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).fillna({"k": "<null>"})
    pdf["rid"] = pdf.sort_values("t").groupby("k").cumcount() + 1
    pdf["n"] = pdf.groupby("k")["t"].transform("size")
    got = got.fillna({"k": "<null>"})
    m = got.merge(pdf, on=["k", "t"], suffixes=("_g", "_w"))
    assert len(m) == len(pdf) == len(got)
    assert (m.rid_g == m.rid_w).all() and (m.n_g == m.n_w).all()


@SETTINGS
@given(rows=rows_st, block=st.integers(10, 25))
def test_block_window_property(spark, rows, block):
    rows = [(k or "x", t, v) for k, t, v in _unique_time(rows)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    idx = ordered_index(df, ["t"], ["k"], "rid", num_partitions=3)
    cols = lambda w: {"ahead": F.lead("v", 10).over(w), "back": F.sum("v").over(w.rowsBetween(-9, 0))}
    got = block_window(idx, ["k"], "rid", cols, behind=9, ahead=10, block_rows=block).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    pdf["ahead"] = pdf.groupby("k")["v"].shift(-10)
    pdf["back"] = pdf.groupby("k")["v"].transform(lambda s: s.rolling(10, min_periods=1).sum())
    m = got.merge(pdf, on=["k", "t"], suffixes=("_g", "_w"))
    assert len(m) == len(pdf)
    for c in ("ahead", "back"):
        a, b = m[f"{c}_g"], m[f"{c}_w"]
        assert ((a - b).abs().fillna(0) < 1e-9).all() and (a.isna() == b.isna()).all()


@SETTINGS
@given(rows=rows_st)
def test_dedup_property(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = dedup_keep_first(df, ["k"], ["t"]).toPandas().fillna({"k": "<null>"})
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).fillna({"k": "<null>"})
    want = pdf.sort_values(["k", "t", "v"]).groupby("k").head(1)
    key = lambda d: sorted(zip(d.k, d.t, d.v))
    assert key(got) == key(want)


@SETTINGS
@given(rows=rows_st, n=st.integers(1, 15), salt=st.integers(1, 5))
def test_latest_n_property(spark, rows, n, salt):
    rows = [(k or "x", t, v) for k, t, v in _unique_time(rows)]
    df = spark.createDataFrame(rows, "symbol string, open_time int, v double").repartition(4)
    got = latest_n(df, n, salt_buckets=salt).toPandas()
    pdf = pd.DataFrame(rows, columns=["symbol", "open_time", "v"])
    want = pdf.sort_values("open_time", ascending=False).groupby("symbol").head(n)
    key = lambda d: sorted(zip(d.symbol, d.open_time))
    assert key(got) == key(want)


@SETTINGS
@given(rows=rows_st, block=st.integers(1, 7))
def test_running_total_property(spark, rows, block):
    from candleflow.operators.sequence import running_total

    rows = [(k or "x", t, v) for k, t, v in _unique_time(rows)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    idx = ordered_index(df, ["t"], ["k"], "rid", num_partitions=3)
    got = running_total(idx, ["k"], "rid", "v", "cum", block_rows=block).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    pdf["cum"] = pdf.groupby("k")["v"].cumsum()
    m = got.merge(pdf, on=["k", "t"], suffixes=("_g", "_w"))
    assert len(m) == len(pdf) and ((m.cum_g - m.cum_w).abs() < 1e-9).all()
