"""Inputs derived from the given tables for queries and tests: run metrics, a
stand-in for stream results, and the replay of a bar table as deliveries.

Nothing here is part of the jobs; they read topics or files.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.operators.compare import PROCESSING_TIME
from candela.schemas import BATCH, STREAMING
from candela.sinks.publish import bar_messages


def metrics_from_events(events: DataFrame) -> DataFrame:
    """A deterministic run-metrics table derived from ``events`` :
    one metric row per event; value = 10 x event value (seconds)."""
    return events.select(
        F.col("ts").alias("execution_date"),
        F.when(F.col("event_id") % 2 == 0, F.lit(BATCH)).otherwise(F.lit(STREAMING)).alias("processing_type"),
        F.when(F.col("event_type") == "error", F.lit("ERROR_TIME")).otherwise(F.lit(PROCESSING_TIME))
         .alias("metric_name"),
        (F.col("value") * 10).alias("metric_value"),
        F.concat(F.col("user_id").cast("string"), F.lit(" records")).alias("window_size"),
        F.to_json(F.struct(F.col("event_id").alias("batch_id"),
                           F.col("user_id").alias("record_count"))).alias("details"))


def restarted_indicator_rows(bars: DataFrame, processing_type: str = STREAMING) -> DataFrame:
    """Indicators restarted every calendar year per ticker.

    Reproduces, deterministically, the cold start of a stream that recomputes
    indicators from scratch for each delivery of one year of bars.
    """
    from candela.plans.batch import indicator_rows
    yearly = bars.withColumn("_year", F.year("date"))
    return indicator_rows(yearly, processing_type, by=("ticker", "_year"))


def delivery_of(date: Column, years: int = 2) -> Column:
    return F.floor(F.year(date) / years)


def deliveries(bars: DataFrame, years: int = 2) -> list[int]:
    """Delivery ids in time order (one per period of the calendar)."""
    return [r[0] for r in bars.select(delivery_of(F.col("date"), years).alias("d")).distinct()
            .orderBy("d").collect()]


def write_delivery(bars: DataFrame, feed_dir: str, delivery: int, copies: int = 1, name: str | None = None,
                   years: int = 2) -> None:
    """Publish the bars of one delivery as JSON text (``copies`` > 1 repeats it)."""
    part = bars.filter(delivery_of(F.col("date"), years) == delivery)
    msgs = bar_messages(part).select("value")
    for c in range(copies):
        msgs.write.mode("overwrite").text(os.path.join(feed_dir, name or f"d{delivery}", f"copy{c}"))


class Replay:
    """A bar table sent as deliveries; a query runs over each with ``availableNow``.

    The query keeps its checkpoint over deliveries, so every delivery after the
    first is a restart that continues (offsets, watermark, state).
    """

    def __init__(self, spark, name: str):
        from candela.plans.stream_job import ProgressLog
        from candela.session import scratch_path
        root = scratch_path(spark, f"stream-{name}")
        self.spark, self.log = spark, ProgressLog()
        self.feed, self.checkpoint, self.out = (os.path.join(root, x) for x in ("feed", "checkpoint", "out"))

    def messages(self) -> DataFrame:
        from candela.streaming.feed import message_stream
        return message_stream(self.spark, self.feed)

    def run(self, bars: DataFrame, start, copies: int = 1, late: DataFrame | None = None,
            corrected: DataFrame | None = None) -> None:
        """``start()`` gives the query; ``late`` rows of the first period are sent at the end,
        ``corrected`` ones of each period after it, to the same run."""
        from candela.plans.stream_job import run_available
        from candela.session import materialize
        bars = materialize(bars)
        ids = deliveries(bars)
        for d in ids:
            write_delivery(bars, self.feed, d, copies=copies)
            if corrected is not None:
                write_delivery(corrected, self.feed, d, name=f"d{d}-corrected")
            run_available(self.spark, start, self.log)
        if late is not None and ids:
            write_delivery(late, self.feed, ids[0], name="late")
            run_available(self.spark, start, self.log)
