"""The bar record and the names of every column this library produces."""

from __future__ import annotations

from pyspark.sql import types as T

# The wire/at-rest bar: one row per (symbol, date), all fields nullable.
BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
])

BAR_COLUMNS = [f.name for f in BAR_SCHEMA.fields]
# Positional layout of a landing CSV (the symbol comes from the file name).
CSV_COLUMNS = ["date", "open", "high", "low", "close", "volume"]
CSV_SCHEMA = T.StructType([f for f in BAR_SCHEMA.fields if f.name != "symbol"])

# Output column names, in output order, per feature stage.
BASIC_COLUMNS = [
    "daily_change", "daily_change_pct", "daily_range", "daily_range_pct",
    "typical_price", "ohlc4", "volume_weighted_price",
]
TECHNICAL_COLUMNS = [
    "sma_7", "sma_20", "sma_50", "avg_volume_20", "price_momentum_1d",
    "price_momentum_7d", "gain", "loss", "price_stddev_20", "volume_ratio",
    "highest_20d", "lowest_20d",
]
ADVANCED_COLUMNS = [
    "bollinger_upper", "bollinger_lower", "stochastic_k", "price_position",
    "volume_category", "short_trend", "medium_trend",
]
STATISTICS_COLUMNS = [
    "price_skewness_30d", "price_kurtosis_30d", "price_q1_30d", "price_q3_30d",
    "price_zscore", "volume_zscore",
]
ML_COLUMNS = [
    "close_lag_1", "close_lag_2", "close_lag_3", "price_deviation_sma7",
    "price_deviation_sma20", "price_movement_category", "is_green_candle",
    "is_high_volume", "next_day_return",
]
ANOMALY_COLUMNS = ["price_anomaly_flag", "volume_anomaly_flag", "combined_anomaly_score"]
REGIME_COLUMNS = ["volatility_regime", "trend_regime"]
PERFORMANCE_COLUMNS = ["cumulative_return", "drawdown", "avg_return_30d", "return_volatility_30d"]

FEATURE_COLUMNS = (BASIC_COLUMNS + TECHNICAL_COLUMNS + ADVANCED_COLUMNS + STATISTICS_COLUMNS
                   + ML_COLUMNS + ANOMALY_COLUMNS + REGIME_COLUMNS + PERFORMANCE_COLUMNS)

# Added by the streaming job around the feature frame.
JOB_COLUMNS = ["processed_timestamp", "processing_date", "price_range", "is_volume_high"]
QUALITY_COLUMNS = ["data_quality_flag", "data_quality_status"]

WEEKLY_COLUMNS = ["symbol", "week", "week_open", "week_high", "week_low", "week_close",
                  "week_volume", "trading_days", "weekly_change_pct"]
MONTHLY_COLUMNS = ["symbol", "month", "month_open", "month_high", "month_low", "month_close",
                   "month_volume", "month_avg_price", "month_volatility"]

# Longest finite look-back of the composite, in rows: the 100-row average of a
# 20-row standard deviation reaches 99 + 19 rows back.  One row of look-ahead
# (next_day_return).
LOOKBACK_ROWS = 118
LOOKAHEAD_ROWS = 1
