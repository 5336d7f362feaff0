"""Tumbling 20-day windows per ticker, collected and flattened back to rows.

The window of a bar is ``window(date, '20 days')`` (aligned to 1970-01-01).
All fields of a row are collected as one struct, so they stay aligned even
when one of them is NULL. ``collect_windows`` collects rows as a set, so a
repeated bar counts once. ``collect_latest`` is the streams' aggregate: a window
has one place for each of its days, and the version of a bar that arrived last
takes it, whether its prices went up or down. State is bounded by the calendar,
however often a bar is sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.sources.arrival import ARRIVAL

DAYS = 20
WINDOW = f"{DAYS} days"
FIELDS = ["date", "open", "high", "low", "close", "adj_close", "volume"]


def with_window(df: DataFrame, time_col: str = "date") -> DataFrame:
    ts = F.col(time_col)
    if dict(df.dtypes)[time_col] == "date":
        ts = ts.cast("timestamp")
    return df.withColumn("window", F.window(ts, WINDOW))


def collect_windows(df: DataFrame, time_col: str = "date") -> DataFrame:
    """(window, ticker, rows: array<struct<date, open, …, volume>>)."""
    return (with_window(df, time_col)
            .groupBy("window", "ticker")
            .agg(F.collect_set(F.struct(*FIELDS)).alias("rows")))


def collect_latest(df: DataFrame, time_col: str = "date") -> DataFrame:
    """(window, ticker, rows, received) of daily bars with an arrival: the last version of each day's bar.

    ``received`` counts the messages of the window, replaced ones and repeats included.
    """
    day = F.datediff(F.col(time_col), F.col("window.start"))
    places = [F.max_by(F.when(day == k, F.struct(*FIELDS)), F.when(day == k, F.col(ARRIVAL))).alias(f"_day_{k}")
              for k in range(DAYS)]
    return (with_window(df, time_col).groupBy("window", "ticker").agg(*places, F.count(F.lit(1)).alias("received"))
            .select("window", "ticker", F.array_compact(F.array(*[f"_day_{k}" for k in range(DAYS)])).alias("rows"), "received"))


def flatten_windows(collected: DataFrame) -> DataFrame:
    """Back to one row per bar, with the window bounds as dates."""
    return collected.select(
        F.col("window.start").cast("date").alias("window_start"),
        F.col("window.end").cast("date").alias("window_end"),
        "ticker", F.inline("rows")).select(
        F.col("date").cast("date").alias("date"), "ticker", "window_start", "window_end",
        "open", "high", "low", "close", "adj_close", "volume")
