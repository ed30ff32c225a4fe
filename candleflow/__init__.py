"""candleflow: a Spark-native candle flow.

Parse landed klines, clean and de-duplicate candles, report data quality,
compute row-offset features with a ten-rows-ahead label, split
chronologically, train and compare Spark ML regressors, and score tables or
streams of feature rows.  Every step takes and returns a DataFrame.
"""

__version__ = "0.1.0"
