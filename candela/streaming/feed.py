"""Bar messages as a stream source.

The source is a Kafka topic (``kafka_options``) or a folder tree of text files
with one JSON message a line; both give the message as ``value`` and when it
arrived (``sources.arrival``): the topic's time, partition and offset, or the
file's time and path and the line's number. So of two versions of a bar the
later one is known. A file is one row until it is divided into lines, so that
lines have numbers; message files are small (2 GB at most). A message that is no JSON, or
whose date or price can't be read, becomes a row that the bar contract rejects;
it keeps its raw text, so it can be stored and counted (``quarantine``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schemas import BAR_MESSAGE
from candela.sources.arrival import ARRIVAL, arrival

RAW = "raw_message"


def message_stream(spark: SparkSession, feed_dir: str | None = None,
                   kafka_options: dict[str, str] | None = None,
                   max_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with ``value`` and arrival of each message.

    ``max_per_trigger`` bounds a micro-batch: offsets of the topic, or files.
    """
    if kafka_options:
        options = dict(kafka_options)
        if max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return (spark.readStream.format("kafka").options(**options).load()
                .select(F.col("value").cast("string").alias("value"),
                        arrival(F.col("timestamp"), F.concat_ws("/", "topic", "partition"), F.col("offset"), F.lit(0))))
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    files = reader.load(os.path.join(feed_dir, "*", "*")).filter("value <> ''")
    lines = F.split(F.regexp_replace("value", r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n", -1)
    return (files.select(F.posexplode(lines).alias("row", "value"), F.col("_metadata.file_modification_time").alias("time"),
                         F.col("_metadata.file_path").alias("path"))
            .select("value", arrival(F.col("time"), F.col("path"), F.lit(0), F.col("row"))))


def decode(messages: DataFrame) -> DataFrame:
    """JSON -> bar columns, the raw text and the arrival (if known); the date becomes the event time (a timestamp)."""
    kept = [RAW, *[c for c in messages.columns if c == ARRIVAL]]
    return (messages.withColumn(RAW, F.col("value")).select(F.from_json(F.col("value"), BAR_MESSAGE).alias("data"), *kept)
                    .select("data.*", *kept)
                    .withColumn("date", F.try_to_timestamp(F.col("date"), F.lit("yyyy-MM-dd"))))


def watermarked(bars: DataFrame, delay: str = "1 day") -> DataFrame:
    return bars.withWatermark("date", delay)
