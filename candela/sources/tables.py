"""Parquet tables of a data directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from candela.operators.bars import daily_bars_from_orders, hourly_bars_from_events


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))


def daily_bars(spark: SparkSession, data_dir: str) -> DataFrame:
    return daily_bars_from_orders(table(spark, data_dir, "orders"))


def hourly_bars(spark: SparkSession, data_dir: str) -> DataFrame:
    return hourly_bars_from_events(table(spark, data_dir, "events"))
