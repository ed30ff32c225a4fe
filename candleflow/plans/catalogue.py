"""The registered queries: each is a Spark job over the driver tables and,
where SQL can say the same, its DuckDB oracle.

Candles come from the ``events`` table through the hourly-bar adapter
(``sources.events``); de-duplication checks run on ``lineitem``, whose
(l_orderkey, l_linenumber) key has real duplicates.  Floating results that
depend on summation order are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import numeric_columns, round_columns, utc_wallclock
from ..operators.clean import dedup_keep_first, dedup_rows, latest_n, sample_rows, to_silver
from ..operators.features import add_features, features
from ..operators.metrics import regression_metrics
from ..operators.quality import correlation, duplicate_report, null_counts, quantile, rows_with_null
from ..operators.ml import compare_models, fit
from ..operators.score import score, score_linear, to_predictions
from ..operators.sketches import merge_sketches, quantile_rank_errors, rank_error, read_sketches, sketch_quantiles, store_sketches
from ..operators.split import chrono_split, time_index, train_test
from ..session import delete_paths, materialize, scratch_path, table
from ..sinks.versions import numbered, publish
from ..sinks.writers import append_predictions, read_runs, save_model, write_kline_bodies
from ..sources.events import bars_from_events
from ..sources.klines import landed_texts, read_klines, split_klines
from ..sources.models import load_model
from ..sources.tables import read_table
from ..streaming.ingest import events_stream, kline_stream, read_bars, start_bars
from ..streaming.incremental import compact_state, read_features, read_scores, start_incremental_features, start_scoring
from .refresh import RefreshPaths, run_refresh, score_table

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
ROUNDED = ("return_1m", "ma_5", "ma_10", "taker_ratio")
LATEST_N = 600
# Fixed coefficients of the ``score_fixed`` query (a linear model given by
# value rather than fitted).
FIXED_INTERCEPT = 1.5
FIXED_WEIGHTS = {
    "return_1m": 100.0,
    "ma_5": 0.5,
    "ma_10": -0.25,
    "volume": 0.0001,
    "close_prev": 0.75,
    "number_of_trades": 0.01,
    "taker_ratio": 2.0,
}
LINEITEM_KEYS = ("l_orderkey", "l_linenumber")
LINEITEM_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
CORR_COLUMNS = (*schemas.MODEL_INPUTS, schemas.LABEL)
# INT/DOUBLE feature columns in table order (what the legacy numeric filter
# keeps; number_of_trades is BIGINT and left out).
LEGACY_NUMERIC = tuple(
    c for c in schemas.FEATURE_COLUMNS if c not in ("symbol", "open_time", "close_time", "number_of_trades")
)


# ---------------------------------------------------------------- Spark side
def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return bars_from_events(table(spark, sf, "events"))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver(_bars(spark, sf))


def _features(spark: SparkSession, sf: str, policy="label_return", layout: bool = False) -> DataFrame:
    return features(_silver(spark, sf), policy, layout=layout)


def _split(spark: SparkSession, sf: str) -> DataFrame:
    """Features and their chronological split in one plan (the split reuses
    the feature window's blocks instead of sorting again)."""
    return chrono_split(_features(spark, sf, layout=True))


def _rounded(df: DataFrame) -> DataFrame:
    return round_columns(df, [c for c in ROUNDED if c in df.columns], DIGITS)


def q_bars_1h(spark, sf):
    return _bars(spark, sf)


def q_features(spark, sf):
    return _rounded(_features(spark, sf))


def q_features_prev_policy(spark, sf):
    return _rounded(_features(spark, sf, "label_return_prev"))


def q_features_derived_policy(spark, sf):
    return _rounded(_features(spark, sf, "derived"))


def q_features_all_policy(spark, sf):
    return _rounded(_features(spark, sf, "all"))


def q_time_index(spark, sf):
    idx = time_index(_features(spark, sf))
    return idx.select("symbol", "open_time", "close", "row_id")


def q_chrono_split(spark, sf):
    s = _split(spark, sf)
    return s.select("symbol", "open_time", "close", "row_id", "split")


def q_dedup_keyed(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINEITEM_COLUMNS)
    return dedup_keep_first(li, LINEITEM_KEYS, LINEITEM_ORDER)


def q_dedup_keyed_last(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINEITEM_COLUMNS)
    return dedup_keep_first(li, LINEITEM_KEYS, LINEITEM_ORDER, keep="last")


def q_duplicate_report(spark, sf):
    return duplicate_report(table(spark, sf, "lineitem"))


def q_dedup_rows(spark, sf):
    return dedup_rows(table(spark, sf, "lineitem"))


def q_null_counts(spark, sf):
    return null_counts(add_features(_silver(spark, sf)))


def q_rows_with_null(spark, sf):
    raw = add_features(_silver(spark, sf))
    return _rounded(rows_with_null(raw).select("symbol", "open_time", "close", *schemas.DERIVED_COLUMNS))


def q_latest_n(spark, sf):
    return latest_n(_bars(spark, sf), LATEST_N)


def q_median_close(spark, sf):
    return quantile(_bars(spark, sf), "close", 0.5, alias="median_close")


def q_median_close_by_symbol(spark, sf):
    return quantile(_bars(spark, sf), "close", 0.5, partition_by=["symbol"], alias="median_close")


def q_correlation(spark, sf):
    return correlation(_features(spark, sf), CORR_COLUMNS, digits=DIGITS)


def q_correlation_numeric(spark, sf):
    """The reference's column choice: every INT/DOUBLE column (BIGINT left
    out), all pairs, over the whole feature table."""
    f = _features(spark, sf)
    return correlation(f, numeric_columns(f, legacy=True), digits=DIGITS)


def q_approx_median_close(spark, sf):
    """The reference's median: a bounded sketch with relative error 0.1."""
    return quantile(_bars(spark, sf), "close", 0.5, rel_err=0.1, alias="median_close")


def q_metrics_persistence(spark, sf):
    s = _split(spark, sf)
    test = s.where(F.col("split") == "test").select(schemas.LABEL, F.col("close_prev").alias("prediction"))
    return regression_metrics(test, model="persistence", digits=DIGITS)


def q_ols_one_input(spark, sf):
    f = _features(spark, sf)
    return f.groupBy("symbol").agg(
        F.round(F.regr_slope(schemas.LABEL, "close_prev"), DIGITS).alias("slope"),
        F.round(F.regr_intercept(schemas.LABEL, "close_prev"), DIGITS).alias("intercept"),
        F.regr_count(schemas.LABEL, "close_prev").alias("n"),
    )


def q_score_fixed(spark, sf):
    scored = score_linear(_features(spark, sf), FIXED_WEIGHTS, FIXED_INTERCEPT)
    return scored.select("symbol", "open_time", F.round("prediction", DIGITS).alias("prediction"))


def q_sample_hash(spark, sf):
    return _rounded(sample_rows(_features(spark, sf), 0.1, ["symbol", "open_time"]))


def _train_test(spark, sf):
    return train_test(_split(spark, sf))


def _prediction_rows(scored: DataFrame) -> DataFrame:
    return scored.select(
        "symbol", "open_time", schemas.LABEL, F.round("prediction", 4).alias("prediction")
    )


def q_train_lr_predictions(spark, sf):
    train, test = _train_test(spark, sf)
    return _prediction_rows(fit(train, "lr").transform(test))


def q_compare_models(spark, sf):
    train, test = _train_test(spark, sf)
    return compare_models(train, test, digits=DIGITS)


def q_model_reload(spark, sf):
    train, test = _train_test(spark, sf)
    path = scratch_path(spark, "model")
    save_model(fit(train, "lr"), path)
    return _prediction_rows(score(test, load_model(path)))


def q_klines_parse(spark, sf):
    landed = scratch_path(spark, "landed")
    write_kline_bodies(_bars(spark, sf), landed)
    bronze = read_klines(spark, landed)
    return bronze.select(
        "symbol",
        F.unix_millis("open_time").alias("open_time_ms"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        F.unix_millis("close_time").alias("close_time_ms"),
        "quote_asset_volume",
        "number_of_trades",
        "taker_buy_base_volume",
        "taker_buy_quote_volume",
        "ignore",
    )


def q_silver_from_klines(spark, sf):
    """Landed kline files -> bronze -> silver (keyed dedup + drop NULLs)."""
    landed = scratch_path(spark, "landed")
    write_kline_bodies(_bars(spark, sf), landed)
    silver = to_silver(read_klines(spark, landed))
    return silver.select(
        "symbol",
        F.unix_millis("open_time").alias("open_time_ms"),
        *[c for c in schemas.SILVER_COLUMNS if c not in ("symbol", "open_time", "close_time")],
    )


def q_prediction_records(spark, sf):
    """Prediction records of the fitted linear model on the test rows."""
    train, test = _train_test(spark, sf)
    recs = to_predictions(score(test, fit(train, "lr")))
    return recs.select("symbol", F.unix_millis("market_time").alias("open_time_ms"), F.round("predicted_price", 4).alias("prediction"))


def q_full_refresh(spark, sf):
    out = run_refresh(spark, _bars(spark, sf), scratch_path(spark, "refresh"), families=("lr",))
    return out.select("model", "metric", F.round("value", 4).alias("value"))


STREAM_CHUNK_DAYS = 10


def _stream_session(spark: SparkSession) -> SparkSession:
    """A sibling session (same context and checkpoint folder) for the stream
    queries, with the cluster's default parallelism for the small shuffles of
    a micro-batch; the caller's session is left unchanged."""
    ss = spark.newSession()
    ss.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return ss


def _period(time_col: str):
    return F.floor(F.unix_date(F.to_date(F.col(time_col))) / F.lit(STREAM_CHUNK_DAYS))


def _land_once(df: DataFrame, time_col: str, tag: str) -> tuple[str, list[int]]:
    """``df`` written once, in a folder per period of STREAM_CHUNK_DAYS days,
    as successive polls land it; and the period numbers, the only thing that
    reaches the driver."""
    path = scratch_path(df.sparkSession, tag)
    df.withColumn("period", _period(time_col)).write.partitionBy("period").parquet(path)
    landed = df.sparkSession.read.parquet(path)
    return path, sorted(r[0] for r in landed.select("period").distinct().collect())


def _stream_out(spark: SparkSession, path: str) -> DataFrame:
    out = read_features(spark, path)
    for c in ("open_time", "close_time"):
        out = out.withColumn(c, utc_wallclock(c))
    return _rounded(out.select(*schemas.FEATURE_COLUMNS))


def q_stream_features(spark, sf):
    """Land the candles as kline files in 10-day polls; after each poll run
    the incremental feature stream to completion (availableNow)."""
    stored, periods = _land_once(_bars(spark, sf), "open_time", "stream-bars-in")
    root = scratch_path(spark, "stream-features")
    ss = _stream_session(spark)
    for p in periods:
        poll = spark.read.parquet(f"{stored}/period={p}")
        write_kline_bodies(poll, f"{root}/landed", mode="append")
        start_incremental_features(kline_stream(ss, f"{root}/landed"), f"{root}/features", f"{root}/state").awaitTermination()
    return _stream_out(spark, f"{root}/features")


def q_stream_features_out_of_order(spark, sf):
    """The same candles in the worst order: the newest period first, with a
    stale copy of each symbol's last candle; then the older periods, one poll
    for each symbol in turn; the last poll repeats the newest period, now
    with the finished candles."""
    stored, periods = _land_once(_bars(spark, sf), "open_time", "stream-bars-in")
    root = scratch_path(spark, "stream-unordered")
    ss = _stream_session(spark)
    newest = spark.read.parquet(f"{stored}/period={periods[-1]}")
    last = newest.groupBy("symbol").agg(F.max("open_time").alias("open_time")).withColumn("stale", F.lit(True))
    stale = newest.join(last, ["symbol", "open_time"], "left").withColumns({
        "number_of_trades": F.when(F.col("stale"), F.col("number_of_trades") - 1).otherwise(F.col("number_of_trades")),
        "close": F.when(F.col("stale"), F.col("close") + 1).otherwise(F.col("close"))}).drop("stale")
    polls = [stale]
    if periods[:-1]:
        older = spark.read.schema(newest.schema).parquet(*[f"{stored}/period={p}" for p in periods[:-1]])
        turn = F.pmod(F.xxhash64("symbol"), F.lit(2))
        polls += [older.where(turn == 1), older.where(turn == 0)]
    for poll in [*polls, newest]:
        write_kline_bodies(poll, f"{root}/landed", mode="append")
        start_incremental_features(kline_stream(ss, f"{root}/landed"), f"{root}/features", f"{root}/state").awaitTermination()
    return _stream_out(spark, f"{root}/features")


def q_stream_bars(spark, sf):
    """Land the events in 10-day polls and run the bar stream after each."""
    stored, periods = _land_once(table(spark, sf, "events"), "ts", "stream-events-in")
    root = scratch_path(spark, "stream-bars")
    ss = _stream_session(spark)
    for p in periods:
        spark.read.parquet(f"{stored}/period={p}").write.mode("append").parquet(f"{root}/landed")
        start_bars(events_stream(ss, f"{root}/landed"), f"{root}/bars", f"{root}/checkpoint").awaitTermination()
    return read_bars(spark, f"{root}/bars")


def q_silver_revised(spark, sf):
    """Bronze that holds each candle as polled half an hour into its hour and
    once more when it was finished; silver keeps the finished one."""
    events = table(spark, sf, "events")
    early = bars_from_events(events.where(F.minute("ts") < 30))
    return to_silver(early.unionByName(bars_from_events(events)))


def q_refresh_replaces(spark, sf):
    """A refresh over all symbols, then one over half of them: the feature
    table holds the second run only."""
    root = scratch_path(spark, "refresh-replaces")
    bars = _bars(spark, sf)
    run_refresh(spark, bars, root, families=("lr",))
    run_refresh(spark, bars.where(F.col("symbol") >= REFRESH_FROM), root, families=("lr",))
    return _rounded(read_table(spark, f"{root}/features").select(*schemas.FEATURE_COLUMNS))


# Symbols that a partitioned table would take for numbers.
NUMBERED_SYMBOLS = {"click": "007", "signup": "1e3"}


def _numbered_symbols(df: DataFrame) -> DataFrame:
    return df.replace(NUMBERED_SYMBOLS, subset=["symbol"])


def _records(records: DataFrame) -> DataFrame:
    return records.select("symbol", F.unix_millis("market_time").alias("open_time_ms"), F.round("predicted_price", 4).alias("prediction"))


def q_score_table(spark, sf):
    """The batch scoring job: a saved model over a feature table partitioned
    by symbol, some of which look like numbers; scored twice under one run id,
    as a retry does, and the records are there once."""
    train, test = _train_test(spark, sf)
    root = scratch_path(spark, "score-table")
    save_model(fit(train, "lr"), f"{root}/model")
    publish(_numbered_symbols(test), f"{root}/features", partition_by=["symbol"])
    for _ in range(2):
        score_table(spark, f"{root}/model", f"{root}/features", f"{root}/records", run_id="retried")
    return _records(read_runs(spark, f"{root}/records"))


def q_score_runs(spark, sf):
    """Two scoring runs over halves of the table, the first repeated after the
    second: each run's records once."""
    train, test = _train_test(spark, sf)
    model, root = fit(train, "lr"), scratch_path(spark, "score-runs")
    scored = to_predictions(score(test, model))
    for run, half in (("a", scored.where(F.col("symbol") < REFRESH_FROM)), ("b", scored.where(F.col("symbol") >= REFRESH_FROM)), ("a", scored.where(F.col("symbol") < REFRESH_FROM))):
        append_predictions(half, f"{root}/records", run_id=run)
    return _records(read_runs(spark, f"{root}/records"))


def q_score_stream(spark, sf):
    """A stream of feature rows scored in micro-batches, the last of which is
    repeated as after a failure; every row has one record."""
    train, test = _train_test(spark, sf)
    root = scratch_path(spark, "score-stream")
    model = fit(train, "lr")
    _numbered_symbols(test).repartition(3, "symbol").write.parquet(f"{root}/features")
    ss = _stream_session(spark)
    stream = ss.readStream.schema(test.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/features")
    for _ in range(2):
        start_scoring(stream, model, f"{root}/scores", f"{root}/checkpoint", model_version="lr-1").awaitTermination()
        # Without its commit the last batch counts as lost, and the next start runs it again.
        delete_paths(spark, [f"{root}/checkpoint/commits/{n}" for n in numbered(spark, f"{root}/scores", "batch_id=")[-1:]])
    return _records(read_scores(spark, f"{root}/scores"))


def q_klines_quarantine(spark, sf):
    """Landed bodies with damaged rows and bodies: what is good, and what is
    rejected for which reason, by symbol."""
    landed = scratch_path(spark, "landed-damaged")
    write_kline_bodies(_bars(spark, sf), landed)
    text, sym = landed_texts(spark, landed)
    trades = schemas.KLINE_FIELDS.index("number_of_trades")

    def damaged(row):
        kind = F.pmod(row[trades].cast("int"), F.lit(DAMAGE_EVERY))

        def with_field(name, value):
            return F.transform(row, lambda x, i: F.when(i == schemas.KLINE_FIELDS.index(name), F.lit(value)).otherwise(x))

        return F.when(kind == 0, with_field("close", "x")).when(kind == 1, F.slice(row, 1, 11)).when(kind == 2, with_field("open_time", "soon")).otherwise(row)

    bodies = F.transform(F.from_json("value", schemas.RAW_KLINE), damaged)
    lost = F.pmod(F.size(bodies), F.lit(DAMAGE_EVERY)) == 0
    good, bad = split_klines(text.select("symbol", F.when(lost, F.lit('{"msg": "try again"}')).otherwise(F.to_json(bodies)).alias("value")), sym)
    reasons = good.select("symbol", F.lit("good").alias("reason")).unionByName(bad.select("symbol", "reason"))
    return reasons.groupBy("symbol", "reason").agg(F.count("*").alias("n"))


def q_stream_features_backfill(spark, sf):
    """The candles with a hole of two days, then the state compacted, then one
    micro-batch that fills the hole and brings the newest days, compacted once
    more, then a poll that repeats the newest period."""
    stored, periods = _land_once(_bars(spark, sf), "open_time", "stream-bars-in")
    root = scratch_path(spark, "stream-backfill")
    ss = _stream_session(spark)
    whole = spark.read.parquet(stored).drop("period")
    first = F.date_add(F.lit("1970-01-01").cast("date"), periods[0] * STREAM_CHUNK_DAYS)
    day = F.datediff(F.to_date("open_time"), first)
    hole, newest = day.between(3, 4), day >= (len(periods) - 1) * STREAM_CHUNK_DAYS

    def poll(rows: DataFrame) -> None:
        write_kline_bodies(rows, f"{root}/landed", mode="append")
        start_incremental_features(kline_stream(ss, f"{root}/landed"), f"{root}/features", f"{root}/state").awaitTermination()

    old = whole.where(~hole & ~newest)
    for rows in (old.where(F.col("symbol") < REFRESH_FROM), old.where(F.col("symbol") >= REFRESH_FROM)):
        poll(rows)
    compact_state(spark, f"{root}/features", f"{root}/state/silver")
    poll(whole.where(hole | newest))
    compact_state(spark, f"{root}/features", f"{root}/state/silver")
    poll(whole.where(newest))
    return _stream_out(spark, f"{root}/features")


def q_quantiles_close(spark, sf):
    bars = materialize(_bars(spark, sf).select("close"), "closes")
    rows = [quantile(bars, "close", q, alias="close").select(F.lit(q).alias("q"), "close") for q in QUANTILES]
    return reduce(DataFrame.unionByName, rows)


def q_features_1m(spark, sf):
    """Features of one-minute bars, each series in several blocks."""
    bars = bars_from_events(table(spark, sf, "events"), "1 minute")
    return _rounded(features(to_silver(bars), block_rows=MINUTE_BLOCK_ROWS))


def q_refresh_quality(spark, sf):
    """A refresh over bronze that holds candles as polled half an hour into
    their hour, some without a volume, and once more when finished: what its
    write jobs counted, other than zero."""
    events = table(spark, sf, "events")
    early = bars_from_events(events.where(F.minute("ts") < 30))
    holes = early.withColumn("volume", F.when(F.col("number_of_trades") % DAMAGE_EVERY != 0, F.col("volume")))
    paths = RefreshPaths(scratch_path(spark, "refresh-quality"))
    run_refresh(spark, holes.unionByName(bars_from_events(events)), paths.root, families=("lr",), run_id="counted")
    return read_runs(spark, paths.quality, "counted").where("value <> 0").select("stage", "metric", "value")


def q_sketch_quantiles(spark, sf):
    """Quantiles of the close per symbol from sketches by day, stored in two
    refreshes that overlap by a period: how many values stand behind each, and
    whether its rank is within twice the sketch's error."""
    stored, periods = _land_once(_bars(spark, sf), "open_time", "sketch-bars")
    path = scratch_path(spark, "sketches")
    bars = spark.read.parquet(stored)
    half = periods[len(periods) // 2]
    for part in (bars.where(F.col("period") <= half), bars.where(F.col("period") >= half)):
        store_sketches(part, path, ["close"])
    merged = merge_sketches(read_sketches(spark, path), ["symbol"])
    answers = sketch_quantiles(merged, QUANTILES, ["symbol"])
    found = quantile_rank_errors(bars, materialize(answers, "sketch-answers"), ["symbol"])
    return found.select("symbol", "q", "n", (F.col("off") <= 2 * rank_error()).alias("within_bound"))


QUANTILES = (0.1, 0.25, 0.9, 0.95)
MINUTE_BLOCK_ROWS = 500
REFRESH_FROM = "l"
DAMAGE_EVERY = 7


QUERIES: dict[str, Query] = {
    "bars_1h": q_bars_1h,
    "features": q_features,
    "features_prev_policy": q_features_prev_policy,
    "features_derived_policy": q_features_derived_policy,
    "features_all_policy": q_features_all_policy,
    "time_index": q_time_index,
    "chrono_split": q_chrono_split,
    "dedup_keyed": q_dedup_keyed,
    "dedup_keyed_last": q_dedup_keyed_last,
    "duplicate_report": q_duplicate_report,
    "dedup_rows": q_dedup_rows,
    "null_counts": q_null_counts,
    "rows_with_null": q_rows_with_null,
    "latest_n": q_latest_n,
    "median_close": q_median_close,
    "median_close_by_symbol": q_median_close_by_symbol,
    "correlation": q_correlation,
    "correlation_numeric": q_correlation_numeric,
    "approx_median_close": q_approx_median_close,
    "metrics_persistence": q_metrics_persistence,
    "ols_one_input": q_ols_one_input,
    "score_fixed": q_score_fixed,
    "sample_hash": q_sample_hash,
    "train_lr_predictions": q_train_lr_predictions,
    "compare_models": q_compare_models,
    "model_reload": q_model_reload,
    "klines_parse": q_klines_parse,
    "silver_from_klines": q_silver_from_klines,
    "prediction_records": q_prediction_records,
    "full_refresh": q_full_refresh,
    "refresh_quality": q_refresh_quality,
    "sketch_quantiles": q_sketch_quantiles,
    "stream_features": q_stream_features,
    "stream_bars": q_stream_bars,
    "stream_features_out_of_order": q_stream_features_out_of_order,
    "silver_revised": q_silver_revised,
    "refresh_replaces": q_refresh_replaces,
    "score_table": q_score_table,
    "score_runs": q_score_runs,
    "score_stream": q_score_stream,
    "klines_quarantine": q_klines_quarantine,
    "stream_features_backfill": q_stream_features_backfill,
    "quantiles_close": q_quantiles_close,
    "features_1m": q_features_1m,
}


# --------------------------------------------------------------- oracle side
_BARS = """
bars as (
  select event_type as symbol,
         time_bucket(interval 1 hour, ts) as open_time,
         arg_min(value, (ts, event_id)) as "open",
         max(value) as high,
         min(value) as low,
         arg_max(value, (ts, event_id)) as "close",
         sum(q) as volume,
         time_bucket(interval 1 hour, ts) + interval 1 hour - interval 1 millisecond as close_time,
         round(sum(value * q), 4) as quote_asset_volume,
         count(*) as number_of_trades,
         sum(case when k % 2 = 0 then q else 0.0 end) as taker_buy_base_volume,
         round(sum(case when k % 2 = 0 then value * q else 0.0 end), 4) as taker_buy_quote_volume
  from (select *,
               cast(json_extract_string(props, '$.k') as int) as k,
               cast(json_extract_string(props, '$.k') as double) + 1.0 as q
        from events)
  group by 1, 2)"""

_EARLY = _BARS.replace("\nbars as (", "\nearly as (").replace("from events)", "from events where minute(ts) < 30)")

_RAW_FEATURES = """
w_feat as (
  select *,
         lead("close", 10) over w as close_t_plus_10,
         lag("close", 1) over w as close_prev,
         avg("close") over (w rows between 4 preceding and current row) as ma_5,
         avg("close") over (w rows between 9 preceding and current row) as ma_10
  from bars
  window w as (partition by symbol order by open_time)),
raw_features as (
  select symbol, open_time, "open", high, low, "close", volume, close_time, quote_asset_volume,
         number_of_trades, taker_buy_base_volume, taker_buy_quote_volume,
         close_t_plus_10, close_prev,
         ("close" - close_prev) / nullif(close_prev, 0) as return_1m,
         ma_5, ma_10,
         taker_buy_base_volume / nullif(volume, 0) as taker_ratio
  from w_feat)"""

_FEATURE_COLS = (
    'symbol, open_time, "open", high, low, "close", volume, close_time, quote_asset_volume, '
    "number_of_trades, taker_buy_base_volume, taker_buy_quote_volume, close_t_plus_10, close_prev"
)
_ROUNDED_COLS = ", ".join(f"round({c}, {DIGITS}) as {c}" for c in ROUNDED)
_ROUNDED_SELECT = (
    f"{_FEATURE_COLS}, round(return_1m, {DIGITS}) as return_1m, round(ma_5, {DIGITS}) as ma_5, "
    f"round(ma_10, {DIGITS}) as ma_10, round(taker_ratio, {DIGITS}) as taker_ratio"
)

_POLICY_WHERE = {
    "label_return": "close_t_plus_10 is not null and return_1m is not null",
    "label_return_prev": "close_t_plus_10 is not null and return_1m is not null and close_prev is not null",
    "derived": " and ".join(f'"{c}" is not null' for c in schemas.DERIVED_COLUMNS),
    "all": " and ".join(f'"{c}" is not null' for c in schemas.FEATURE_COLUMNS),
}


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes)


def _features_cte(policy: str = "label_return") -> str:
    return f"""
features as (select * from raw_features where {_POLICY_WHERE[policy]})"""


def _features_sql(policy: str) -> str:
    return _with(_BARS, _RAW_FEATURES, _features_cte(policy)) + f"\nselect {_ROUNDED_SELECT} from features"


_SPLIT = """
split as (
  select *,
         row_number() over (partition by symbol order by open_time) as row_id,
         count(*) over (partition by symbol) as n_rows
  from features)"""


def _corr_sql(columns=CORR_COLUMNS) -> str:
    cols = list(columns)
    complete = " and ".join(f'"{c}" is not null' for c in cols)
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1 :]:
            parts.append(
                f"select '{a}' as col_a, '{b}' as col_b, round(corr(\"{a}\", \"{b}\"), {DIGITS}) as corr "
                f"from features where {complete}"
            )
    return _with(_BARS, _RAW_FEATURES, _features_cte()) + "\n" + "\nunion all\n".join(parts)


def _fixed_score_expr() -> str:
    terms = [f"{FIXED_INTERCEPT!r}"] + [f"{w!r} * cast({c} as double)" for c, w in FIXED_WEIGHTS.items()]
    return " + ".join(terms)


_LI_COLS = ", ".join(LINEITEM_COLUMNS)
_LI_TIE = ", ".join(
    [*LINEITEM_ORDER, *[c for c in LINEITEM_COLUMNS if c not in LINEITEM_KEYS and c not in LINEITEM_ORDER]]
)


def _li_order(direction: str) -> str:
    null_order = "nulls first" if direction == "asc" else "nulls last"
    return ", ".join(f"{c} {direction} {null_order}" for c in _LI_TIE.split(", "))


_LR_IN = ", ".join(f'cast("{c}" as double) as x{i}' for i, c in enumerate(schemas.MODEL_INPUTS))


def _least_squares() -> str:
    """CTEs up to ``fitted``: the least-squares prediction of every row from
    the seven inputs, fitted on the training rows.  The inputs are centred and
    made orthogonal one after the other; each step takes sums of one row."""
    k = len(schemas.MODEL_INPUTS)
    xs = range(k)
    ctes = [f"""
step0 as (select symbol, open_time, {schemas.LABEL} as label, row_id <= (n_rows * 8) // 10 as train, {_LR_IN}, cast({schemas.LABEL} as double) as y
          from split)""", f"""
mean0 as (select {", ".join(f"avg(x{i}) as m{i}" for i in xs)}, avg(y) as my from step0 where train)""", f"""
lin0 as (select symbol, open_time, label, train, {", ".join(f"x{i} - m{i} as x{i}" for i in xs)}, y - my as y, my as p from step0, mean0)"""]
    for j in xs:
        rest = range(j + 1, k)
        ctes.append(f"""
sum{j + 1} as (select {", ".join([f"sum(x{j} * x{i}) / sum(x{j} * x{j}) as a{i}" for i in rest] + [f"sum(x{j} * y) / sum(x{j} * x{j}) as b"])}
          from lin{j} where train)""")
        ctes.append(f"""
lin{j + 1} as (select symbol, open_time, label, train, {", ".join([f"x{i} - a{i} * x{j} as x{i}" for i in rest] + [""])}y - b * x{j} as y, p + b * x{j} as p
          from lin{j}, sum{j + 1})""")
    ctes.append(f"""
fitted as (select symbol, open_time, label as {schemas.LABEL}, p as prediction from lin{k} where not train)""")
    return ",".join(ctes)


_FITTED = _with(_BARS, _RAW_FEATURES, _features_cte(), _SPLIT) + "," + _least_squares()
_METRICS = f"""
m as (select sqrt(avg((prediction - y) * (prediction - y))) as rmse, avg(abs(prediction - y)) as mae,
             1 - sum((prediction - y) * (prediction - y)) / (var_pop(y) * count(*)) as r2
      from (select {schemas.LABEL} as y, prediction from fitted))
select 'lr' as model, 'rmse' as metric, round(rmse, 4) as value from m
union all select 'lr', 'mae', round(mae, 4) from m
union all select 'lr', 'r2', round(r2, 4) from m"""
_PREDICTIONS = f"\nselect symbol, open_time, {schemas.LABEL}, round(prediction, 4) as prediction from fitted"

_NUMBERED = "case symbol " + " ".join(f"when '{k}' then '{v}'" for k, v in NUMBERED_SYMBOLS.items()) + " else symbol end"

ORACLE: dict[str, str] = {
    "stream_features_out_of_order": _features_sql("label_return"),
    "silver_revised": _with(_BARS) + "\nselect * from bars",
    "refresh_replaces": _features_sql("label_return") + f" where symbol >= '{REFRESH_FROM}'",
    "train_lr_predictions": _FITTED + _PREDICTIONS,
    "model_reload": _FITTED + _PREDICTIONS,
    "full_refresh": _FITTED + "," + _METRICS,
    "prediction_records": _FITTED + "\nselect symbol, epoch_ms(open_time) as open_time_ms, round(prediction, 4) as prediction from fitted",
    "score_table": _FITTED + f"\nselect {_NUMBERED} as symbol, epoch_ms(open_time) as open_time_ms, round(prediction, 4) as prediction from fitted",
    "score_stream": _FITTED + f"\nselect {_NUMBERED} as symbol, epoch_ms(open_time) as open_time_ms, round(prediction, 4) as prediction from fitted",
    "score_runs": _FITTED + "\nselect symbol, epoch_ms(open_time) as open_time_ms, round(prediction, 4) as prediction from fitted",
    "stream_features_backfill": _features_sql("label_return"),
    "klines_quarantine": _with(_BARS) + f""",
bodies as (select symbol, open_time::date as day, count(*) as n from bars group by 1, 2),
faults as (
  select b.symbol, case number_of_trades % {DAMAGE_EVERY} when 0 then 'bad number: close' when 1 then 'row has fewer than 12 fields' when 2 then 'bad time: open_time' else 'good' end as reason
  from bars b join bodies d on b.symbol = d.symbol and b.open_time::date = d.day where d.n % {DAMAGE_EVERY} <> 0
  union all select symbol, 'body is no array of arrays' from bodies where n % {DAMAGE_EVERY} = 0)
select symbol, reason, count(*)::bigint as n from faults group by 1, 2""",
    "sketch_quantiles": _with(_BARS) + f"""
select symbol, q, count("close") as n, true as within_bound
from bars, (select unnest([{", ".join(map(str, QUANTILES))}])::double as q) group by 1, 2""",
    "refresh_quality": _with(_BARS, _EARLY, _RAW_FEATURES, _features_cte()) + f""",
sizes as (select (select count(*) from bars) as b, (select count(*) from early) as e,
                 (select count(*) from early where number_of_trades % {DAMAGE_EVERY} = 0) as h, (select count(*) from features) as f)
select u.stage, u.metric, u.value::bigint as value from sizes, unnest([
  {{'stage': 'bronze', 'metric': 'n_rows', 'value': b + e}}, {{'stage': 'bronze', 'metric': 'complete_rows', 'value': b + e - h}},
  {{'stage': 'bronze', 'metric': 'nulls_volume', 'value': h}}, {{'stage': 'silver', 'metric': 'n_rows', 'value': b}},
  {{'stage': 'silver', 'metric': 'complete_rows', 'value': b}}, {{'stage': 'silver', 'metric': 'duplicate_rows', 'value': e - h}},
  {{'stage': 'features', 'metric': 'n_rows', 'value': f}}, {{'stage': 'features', 'metric': 'complete_rows', 'value': f}}]) as t(u)
where u.value <> 0""",
    "quantiles_close": _with(_BARS) + "\n" + "\nunion all\n".join(
        f'select cast({q} as double) as q, quantile_disc("close", {q}) as "close" from bars' for q in QUANTILES),
    "features_1m": _features_sql("label_return").replace("interval 1 hour", "interval 1 minute"),
    "bars_1h": _with(_BARS) + "\nselect * from bars",
    "features": _features_sql("label_return"),
    "stream_features": _features_sql("label_return"),
    "features_prev_policy": _features_sql("label_return_prev"),
    "features_derived_policy": _features_sql("derived"),
    "features_all_policy": _features_sql("all"),
    "time_index": _with(_BARS, _RAW_FEATURES, _features_cte())
    + '\nselect symbol, open_time, "close", row_number() over (order by open_time, symbol) as row_id from features',
    "chrono_split": _with(_BARS, _RAW_FEATURES, _features_cte(), _SPLIT)
    + '\nselect symbol, open_time, "close", row_id, '
    + "case when row_id <= (n_rows * 8) // 10 then 'train' else 'test' end as split from split",
    "dedup_keyed": f"""select {_LI_COLS} from (
  select {_LI_COLS}, row_number() over (partition by l_orderkey, l_linenumber order by {_li_order('asc')}) as rn
  from lineitem) where rn = 1""",
    "dedup_keyed_last": f"""select {_LI_COLS} from (
  select {_LI_COLS}, row_number() over (partition by l_orderkey, l_linenumber order by {_li_order('desc')}) as rn
  from lineitem) where rn = 1""",
    "duplicate_report": """select total_rows, distinct_rows, total_rows - distinct_rows as duplicate_rows
from (select count(*) as total_rows from lineitem), (select count(*) as distinct_rows from (select distinct * from lineitem))""",
    "dedup_rows": "select distinct * from lineitem",
    "null_counts": _with(_BARS, _RAW_FEATURES)
    + "\nselect count(*) as n_rows, "
    + ", ".join(f'count(*) filter (where "{c}" is null) as nulls_{c}' for c in schemas.FEATURE_COLUMNS)
    + " from raw_features",
    "rows_with_null": _with(_BARS, _RAW_FEATURES)
    + '\nselect symbol, open_time, "close", close_t_plus_10, close_prev, '
    + _ROUNDED_COLS
    + " from raw_features where "
    + " or ".join(f'"{c}" is null' for c in schemas.FEATURE_COLUMNS),
    "latest_n": _with(_BARS)
    + f"""\nselect symbol, open_time, "open", high, low, "close", volume, close_time, quote_asset_volume,
       number_of_trades, taker_buy_base_volume, taker_buy_quote_volume
from (select *, row_number() over (partition by symbol order by open_time desc) as rn from bars)
where rn <= {LATEST_N}""",
    "median_close": _with(_BARS) + '\nselect quantile_disc("close", 0.5) as median_close from bars',
    "median_close_by_symbol": _with(_BARS)
    + '\nselect symbol, quantile_disc("close", 0.5) as median_close from bars group by symbol',
    "correlation": _corr_sql(),
    "correlation_numeric": _corr_sql(LEGACY_NUMERIC),
    "metrics_persistence": _with(_BARS, _RAW_FEATURES, _features_cte(), _SPLIT)
    + f""",
test as (select close_t_plus_10 as y, close_prev - close_t_plus_10 as e from split
         where row_id > (n_rows * 8) // 10 and close_prev is not null),
m as (select sqrt(avg(e * e)) as rmse, avg(abs(e)) as mae,
             1 - sum(e * e) / (var_pop(y) * count(*)) as r2 from test)
select 'persistence' as model, 'rmse' as metric, round(rmse, {DIGITS}) as value from m
union all select 'persistence', 'mae', round(mae, {DIGITS}) from m
union all select 'persistence', 'r2', round(r2, {DIGITS}) from m""",
    "ols_one_input": _with(_BARS, _RAW_FEATURES, _features_cte())
    + f"""\nselect symbol, round(regr_slope(close_t_plus_10, close_prev), {DIGITS}) as slope,
       round(regr_intercept(close_t_plus_10, close_prev), {DIGITS}) as intercept,
       cast(regr_count(close_t_plus_10, close_prev) as bigint) as n
from features group by symbol""",
    "silver_from_klines": _with(_BARS)
    + """\nselect symbol, epoch_ms(open_time) as open_time_ms, "open", high, low, "close", volume,
       quote_asset_volume, number_of_trades, taker_buy_base_volume, taker_buy_quote_volume
from bars""",
    "stream_bars": _with(_BARS) + "\nselect * from bars",
    "klines_parse": _with(_BARS)
    + """\nselect symbol, epoch_ms(open_time) as open_time_ms, "open", high, low, "close", volume,
       epoch_ms(close_time) as close_time_ms, quote_asset_volume, number_of_trades,
       taker_buy_base_volume, taker_buy_quote_volume, '0' as "ignore"
from bars""",
    "score_fixed": _with(_BARS, _RAW_FEATURES, _features_cte())
    + f"\nselect symbol, open_time, round({_fixed_score_expr()}, {DIGITS}) as prediction from features",
}
