"""Ingest -> publish -> batch -> stream -> compare, in order, into one output folder.

1. ingest:  valid bars are added to ``raw_stock_data`` only for new (date,
            ticker); rejected ones go to ``rejected_bars``
2. publish: the stored bars go out as messages, to a topic or to message files
3. batch:   indicators (keyed upsert), signals (replaced by key), run metric
4. stream:  the windowed stream job over these messages, until it has read all
5. compare: stream-vs-batch differences, signal agreement and run times,
            written as the nested JSON report
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators import compare as C
from candela.operators.quality import BAR_FINITE, quarantine
from candela.plans import batch, stream_job
from candela.session import materialize, prepare
from candela.sinks import publish
from candela.sinks.keyed import insert_parquet
from candela.sinks.report import write_report


def ingest(spark: SparkSession, bars: DataFrame, out_dir: str) -> DataFrame:
    """Insert-if-absent of the valid bars; the stored table."""
    path = os.path.join(out_dir, "raw_stock_data")
    valid, rejected = quarantine(bars)
    rejected.write.mode("overwrite").parquet(os.path.join(out_dir, "rejected_bars", "leg=ingest"))
    insert_parquet(spark, path, valid, ["date", "ticker"])
    return spark.read.parquet(path)


def publish_bars(raw: DataFrame, feed_dir: str | None, topic: str | None, options: dict[str, str] | None) -> None:
    """The bars in the order of their days, so that the stream's watermark passes none of them."""
    ordered = raw.repartitionByRange("date").sortWithinPartitions("date", "ticker")
    messages = publish.bar_messages(ordered.withColumns({c: F.col(c).cast("double") for c in BAR_FINITE}))
    publish.publish(messages, options, topic=topic, path=None if topic else os.path.join(feed_dir, "load=0"))


def run_all(spark: SparkSession, bars: DataFrame, out_dir: str, *, topic: str | None = None,
            kafka_options: dict[str, str] | None = None) -> DataFrame:
    """Run every job; returns the flat report row (also written as JSON).

    With ``topic`` and ``kafka_options`` (brokers) messages go through Kafka, else
    through files below ``out_dir``.
    """
    prepare(spark)
    raw = ingest(spark, bars, out_dir)
    feed_dir = os.path.join(out_dir, "raw_messages")
    publish_bars(raw, feed_dir, topic, kafka_options)
    batch.run(spark, raw, out_dir)
    source = ({"kafka_options": {**(kafka_options or {}), "subscribe": topic, "startingOffsets": "earliest"}} if topic
              else {"feed_dir": feed_dir})
    stream_job.run_available(spark, lambda: stream_job.start_indicator_job(
        spark, out_dir, os.path.join(out_dir, "checkpoint"), trigger=stream_job.AVAILABLE, **source))

    ind = spark.read.parquet(os.path.join(out_dir, "technical_indicators"))
    sig = spark.read.parquet(os.path.join(out_dir, "trading_signals"))
    metrics = spark.read.parquet(os.path.join(out_dir, "performance_metrics"))
    flat = C.report(C.perf_summary(C.processing_times(metrics)),
                    C.indicator_accuracy(C.compare_indicators(ind)),
                    C.signal_agreement(C.signal_counts(sig)))
    flat = materialize(flat)
    write_report(flat, os.path.join(out_dir, "results"))
    return flat
