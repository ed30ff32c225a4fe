"""Stage schemas and fixed column lists.

Every stage of the candle flow has a declared schema; nothing is inferred
between stages.  The column names and the order of the model inputs are
fixed values that must stay as they are for saved models to keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Positional field names of one raw kline array (12 fields, in this order).
KLINE_FIELDS = (
    "open_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
    "ignore",
)
# Kline fields that arrive as decimal strings and become doubles.
KLINE_PRICE_FIELDS = (
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_asset_volume",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
)
# Kline fields that arrive as epoch milliseconds.
KLINE_TIME_FIELDS = ("open_time", "close_time")

# Model inputs, in the order the feature vector is assembled.
MODEL_INPUTS = (
    "return_1m",
    "ma_5",
    "ma_10",
    "volume",
    "close_prev",
    "number_of_trades",
    "taker_ratio",
)
LABEL = "close_t_plus_10"
# Horizon of the label and the trailing frames, in rows.
LABEL_LEAD_ROWS = 10
PREV_LAG_ROWS = 1
MA_SHORT_ROWS = 5
MA_LONG_ROWS = 10
# Derived feature columns appended to silver, in output order.
DERIVED_COLUMNS = (
    "close_t_plus_10",
    "close_prev",
    "return_1m",
    "ma_5",
    "ma_10",
    "taker_ratio",
)
# Null policies applied after feature creation.
NULL_POLICIES = {
    "label_return": ("close_t_plus_10", "return_1m"),
    "label_return_prev": ("close_t_plus_10", "return_1m", "close_prev"),
    "derived": DERIVED_COLUMNS,
    "all": None,  # every column
}
DEFAULT_NULL_POLICY = "label_return"
# Chronological split: the first 8/10 of the rows of a series train.
TRAIN_NUMERATOR = 8
TRAIN_DENOMINATOR = 10
# Estimator settings of the three compared model families.
LR_PARAMS = {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.0}
GBT_PARAMS = {"maxIter": 100, "maxDepth": 5, "seed": 42}
RF_PARAMS = {"numTrees": 50, "maxDepth": 7, "seed": 42}
METRICS = ("rmse", "mae", "r2")
# --- end of fixed values ----------------------------------------------------

SYMBOL = "symbol"
OPEN_TIME = "open_time"


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


# Raw positional row as landed: array of 12 strings (numbers kept as text).
RAW_KLINE = T.ArrayType(T.ArrayType(T.StringType()))

BRONZE = T.StructType(
    [
        _f("symbol", T.StringType()),
        _f("open_time", T.TimestampType()),
        _f("open", T.DoubleType()),
        _f("high", T.DoubleType()),
        _f("low", T.DoubleType()),
        _f("close", T.DoubleType()),
        _f("volume", T.DoubleType()),
        _f("close_time", T.TimestampType()),
        _f("quote_asset_volume", T.DoubleType()),
        _f("number_of_trades", T.LongType()),
        _f("taker_buy_base_volume", T.DoubleType()),
        _f("taker_buy_quote_volume", T.DoubleType()),
        _f("ignore", T.StringType()),
    ]
)

SILVER_COLUMNS = tuple(f.name for f in BRONZE.fields if f.name != "ignore")

FEATURE_COLUMNS = SILVER_COLUMNS + DERIVED_COLUMNS
FEATURES = T.StructType(
    [f for f in BRONZE.fields if f.name != "ignore"] + [_f(c, T.DoubleType()) for c in DERIVED_COLUMNS]
)

PREDICTION = T.StructType(
    [
        _f("id", T.StringType(), False),
        _f("market_time", T.TimestampType()),
        _f("predicted_price", T.DoubleType()),
        _f("created_at", T.TimestampType()),
    ]
)

METRIC_ROW = T.StructType(
    [
        _f("model", T.StringType()),
        _f("metric", T.StringType()),
        _f("value", T.DoubleType()),
    ]
)
