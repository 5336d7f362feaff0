"""Bars (open/high/low/close/volume per key and period) from raw rows.

A bar is an aggregate over all rows of one (ticker, period): open and close
are the prices of the first and last row, high/low the extremes, volume the
row count. ``min_by``/``max_by``/``min``/``max``/``count`` all aggregate
partially on the map side, so a hot ticker is reduced to one row per task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bars(df: DataFrame, ticker: Column, period: Column, price: Column, seq: Column,
         period_name: str = "date") -> DataFrame:
    """Generic OHLCV bars; ``seq`` orders rows inside a period (first/last)."""
    return (df.select(ticker.alias("ticker"), period.alias(period_name),
                      price.alias("_price"), seq.alias("_seq"))
              .groupBy("ticker", period_name)
              .agg(F.min_by("_price", "_seq").alias("open"),
                   F.max("_price").alias("high"),
                   F.min("_price").alias("low"),
                   F.max_by("_price", "_seq").alias("close"),
                   F.count(F.lit(1)).alias("volume"))
              .withColumn("adj_close", F.col("close"))
              .select(period_name, "ticker", "open", "high", "low", "close", "adj_close", "volume"))


def daily_bars_from_orders(orders: DataFrame) -> DataFrame:
    """Daily bars: ticker = order priority, price = order total, order key sequences."""
    return bars(orders, F.col("o_orderpriority"), F.to_date("o_orderdate"),
                F.col("o_totalprice"), F.col("o_orderkey"))


def hourly_bars_from_events(events: DataFrame) -> DataFrame:
    """Hourly bars: ticker = event type, price = event value, event time sequences."""
    return bars(events, F.col("event_type"), F.date_trunc("hour", F.col("ts")),
                F.col("value"), F.col("ts"), period_name="time")
