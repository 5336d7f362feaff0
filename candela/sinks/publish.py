"""JSON message encoding and publishing (topic or text files).

One ``to_json(struct(...))`` expression per DataFrame, never one job per row.
Values are published as they are, unrounded; dates as ``yyyy-MM-dd`` text. NULL
fields are left out of the message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.schemas import INDICATOR_COLUMNS

BAR_FIELDS = ["open", "high", "low", "close", "adj_close", "volume"]
SIGNAL_FIELDS = ["signal_type", "signal_strength", "signal_source", "description"]


def _messages(df: DataFrame, fields: list[str]) -> DataFrame:
    day: Column = F.date_format("date", "yyyy-MM-dd").alias("date")
    return df.select(F.col("ticker").alias("key"), F.to_json(F.struct(day, "ticker", *fields)).alias("value"))


def bar_messages(bars: DataFrame) -> DataFrame:
    """``key`` (ticker, so one ticker stays in one topic partition) and ``value``."""
    return _messages(bars, BAR_FIELDS)


def indicator_messages(indicators: DataFrame) -> DataFrame:
    return _messages(indicators, INDICATOR_COLUMNS)


def signal_messages(signals: DataFrame) -> DataFrame:
    return _messages(signals, SIGNAL_FIELDS)


def publish(messages: DataFrame, options: dict[str, str] | None = None,
            path: str | None = None, topic: str | None = None) -> None:
    """Write messages to a Kafka topic (``options`` holds the broker settings)
    or, without a broker, as text files in a folder of their own (one message per
    line; the folder is replaced, so a repeated batch publishes once)."""
    if topic is not None:
        (messages.write.format("kafka").options(**(options or {}))
                 .option("topic", topic).save())
    else:
        messages.select("value").write.mode("overwrite").text(path)
