"""Fixed schemas of the data model (bar messages, CSV files, stored tables)."""

from __future__ import annotations

from pyspark.sql import types as T

# Processing types, signal vocabulary and indicator names.
BATCH = "BATCH"
STREAMING = "STREAMING"

INDICATOR_COLUMNS = [
    "sma_5", "sma_10", "sma_20", "ema_12", "ema_26",
    "macd", "macd_signal", "macd_histogram", "rsi_14",
    "bollinger_upper", "bollinger_middle", "bollinger_lower",
]

BAR_COLUMNS = ["date", "ticker", "open", "high", "low", "close", "adj_close", "volume"]

# JSON bar message as published to the raw-data topic (prices as double).
BAR_MESSAGE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# CSV bar file, read by position; the header row is skipped.
CSV_BARS = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Adj Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
])

# Stored precision of prices and indicators (NUMERIC(16,6)) and of strength (NUMERIC(5,2)).
PRICE_DECIMAL = T.DecimalType(16, 6)
STRENGTH_DECIMAL = T.DecimalType(5, 2)
