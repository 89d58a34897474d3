"""Schemas, key names and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ("symbol", "timeframe")
TS = "timestamp"
PRICE_COLS = ("open", "high", "low", "close", "volume")

OHLCV_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in PRICE_COLS]
)

BARS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("timeframe", T.StringType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
    ]
    + [T.StructField(c, T.DoubleType(), True) for c in PRICE_COLS]
)

# Bar length of each timeframe name, in seconds.
TIMEFRAMES = {
    "1m": 60,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "4h": 14400,
    "1d": 86400,
}

# Ternary-label horizon (bars) and threshold per timeframe.
LABEL_SETTINGS = {
    "1m": (12, 0.0002),
    "5m": (12, 0.0005),
    "15m": (4, 0.0015),
    "1h": (4, 0.003),
}

# Wide kline field names in exchange order.
KLINE_FIELDS = (
    "timestamp",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
    "ignore",
)

# Indicator table columns produced by the indicator bundle.
INDICATOR_COLS = (
    "return1",
    "ema12",
    "ema26",
    "macd",
    "macd_signal",
    "macd_hist",
    "rsi14",
    "atr14",
    "vwap14",
    "obv",
    "spread",
)

# The 36-column model feature set, in model order.
MODEL_FEATURES = (
    "open", "high", "low", "close", "volume",
    "return1", "ema12", "ema26", "macd", "macd_signal", "macd_hist",
    "rsi14", "atr14", "vwap14", "obv", "spread",
    "close_lag_1", "return_1", "close_lag_2", "return_2",
    "close_lag_3", "return_3", "close_lag_6", "return_6",
    "close_lag_12", "return_12",
    "rolling_mean_14", "rolling_std_14", "volatility", "momentum14",
    "price_range", "vol_mean_14", "vol_spike", "ema_ratio",
    "price_high_low", "atr14_simple",
)
