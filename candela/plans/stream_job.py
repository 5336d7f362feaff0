"""The stream jobs: messages in, stored and published indicators and signals out.

``start_indicator_job`` is the continuous job: give it a topic (or a folder of
message files), where to write, a checkpoint path that stays the same over
restarts, and a trigger. ``run_available`` runs the same queries once over what
has arrived.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from candela.functions.signals import signals
from candela.operators.quality import rejection
from candela.plans.batch import INDICATOR_KEY, indicator_rows, metric_row
from candela.schemas import STREAMING
from candela.session import materialize, observed, scratch_scope, together
from candela.sinks import ledger, publish
from candela.sinks.keyed import replace_parquet, upsert_parquet
from candela.sources.arrival import ARRIVAL
from candela.streaming import feed
from candela.streaming.state import KeyedState
from candela.streaming.stateful import STATE_SCHEMA, continue_indicators
from candela.streaming.windows import collect_latest, flatten_windows

CONTINUOUS = {"processingTime": "10 seconds"}
AVAILABLE = {"availableNow": True}


class ProgressLog(StreamingQueryListener):
    """All progress reports of a session's queries while it listens (``recentProgress`` keeps 100)."""

    def __init__(self):
        self.progress: list[dict] = []
        self.ended: set[str] = set()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        self.progress.append(json.loads(event.progress.json))

    def onQueryTerminated(self, event):
        self.ended.add(str(event.runId))


def run_available(spark: SparkSession, start, log: ProgressLog | None = None) -> None:
    """Start queries (``start()`` gives one or several), wait until they end, raise their errors."""
    log = log or ProgressLog()
    spark.streams.addListener(log)
    queries: list[StreamingQuery] = []
    try:
        started = start()
        queries += started if isinstance(started, list) else [started]
        for q in queries:
            q.awaitTermination()
        for q in queries:
            if q.exception() is not None:
                raise q.exception()
    finally:
        # Reports arrive a little after the query's end, at one listener after the other.
        deadline = time.time() + 60
        runs = {str(q.runId) for q in queries}
        while not runs <= log.ended and time.time() < deadline:
            time.sleep(0.05)
        spark.streams.removeListener(log)
        for run in runs & set(_listeners):
            spark.streams.removeListener(_listeners.pop(run))


class BatchMetrics(StreamingQueryListener):
    """Writes a metric row for each micro-batch with rows from its progress report.

    The details hold what Spark observed while the batch ran: bars in the touched
    windows, repeated or replaced messages there, rows that came too late, the
    input and the time. A report that is handled again replaces its row.
    """

    def __init__(self, spark: SparkSession, out_dir: str, query_name: str):
        self.spark, self.out_dir, self.query_name = spark, out_dir, query_name
        self.rows_written = 0

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        report = json.loads(event.progress.json)
        if report.get("name") == self.query_name:
            row = batch_metric(report)
            if row is not None:
                path = os.path.join(self.out_dir, "performance_metrics", f"run=stream-{report['batchId']}")
                metric_row(self.spark, *row).write.mode("overwrite").parquet(path)
                self.rows_written += 1


OBSERVED = "windows"


def batch_metric(report: dict) -> tuple | None:
    """(processing type, seconds, window text, details) of a progress report; None for a batch without rows."""
    seen = report.get("observedMetrics", {}).get(OBSERVED) or {}
    records, received = int(seen.get("records") or 0), int(seen.get("received") or 0)
    late = dropped_late_rows([report])
    if not records and not late:
        return None
    millis = float(report.get("durationMs", {}).get("triggerExecution", 0))
    details = {"batch_id": int(report["batchId"]), "record_count": records, "processing_time_ms": millis,
               "repeat_count": received - records, "late_count": late}
    return STREAMING, millis / 1000.0, f"{records} records", details


def dropped_late_rows(progress: list[dict]) -> int:
    return sum(int(op.get("numRowsDroppedByWatermark", 0))
               for p in progress for op in p.get("stateOperators", []))


def valid_bars(messages: DataFrame) -> DataFrame:
    """Bars of the messages that keep the bar contract (with their arrival, if it is known)."""
    return feed.decode(messages).filter(rejection().isNull()).drop(feed.RAW)


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The raw text of all other messages, with the reason."""
    return (feed.decode(messages).withColumn("reason", rejection()).filter("reason IS NOT NULL")
            .select("reason", feed.RAW))


def start_rejects(messages: DataFrame, out_dir: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (rejected_messages(messages).writeStream.format("parquet")
            .option("path", os.path.join(out_dir, "rejected_messages"))
            .option("checkpointLocation", os.path.join(checkpoint, "rejected")).trigger(**trigger).start())


def indicator_batch(out_dir: str, publish_options: dict[str, str] | None = None,
                    topics: dict[str, str] | None = None):
    """The callback of one micro-batch of windows.

    Indicators over the pooled rows of the touched windows (the warm-up restarts
    in every batch) are computed in one plan, so the batch is evaluated once, and
    stored; months that they touch are observed on the way. Then there is one job
    for each output, all at the same time: keyed upsert, signals of the same keys
    replaced, two message outputs. All of them replace by key or by batch and the batch's marker is
    written last (``sinks.ledger``), so a batch that stopped half-way leaves the
    same tables when it is run again. A batch without rows does nothing. With
    ``topics`` (names for ``indicators`` and ``signals``) messages go to Kafka,
    else to text files.
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if ledger.is_committed(spark, out_dir, batch_id):
            return
        with scratch_scope(spark):
            seen = Observation()
            rows = indicator_rows(flatten_windows(df), STREAMING, bounded=True)
            month = F.date_format("date", "yyyy-MM")
            ind = materialize(rows.observe(seen, F.collect_set(month).alias("months")))
            touched = [(STREAMING, m) for m in sorted(observed(seen).get("months") or ())]
            if not touched:
                return
            found = signals(ind)

            def publish_as(name: str, messages: DataFrame):
                return lambda: publish.publish(messages, publish_options, topic=(topics or {}).get(name),
                                               path=os.path.join(out_dir, "messages", name, f"batch_id={batch_id}"))
            together(spark,
                     lambda: upsert_parquet(spark, os.path.join(out_dir, "technical_indicators"), ind, INDICATOR_KEY, touched),
                     lambda: replace_parquet(spark, os.path.join(out_dir, "trading_signals"), found, ind, INDICATOR_KEY, touched),
                     publish_as("indicators", publish.indicator_messages(ind)),
                     publish_as("signals", publish.signal_messages(found)))
            ledger.commit(spark, out_dir, batch_id)
    return sink


def start_indicator_job(spark: SparkSession, out_dir: str, checkpoint: str, *, feed_dir: str | None = None,
                        kafka_options: dict[str, str] | None = None, max_per_trigger: int | None = None,
                        trigger: dict | None = None, publish_options: dict[str, str] | None = None,
                        topics: dict[str, str] | None = None) -> list[StreamingQuery]:
    """Start the windowed indicator job and the query that stores rejected messages.

    ``kafka_options`` (brokers, ``subscribe``) or ``feed_dir`` is the source,
    ``max_per_trigger`` bounds a micro-batch, ``trigger`` defaults to every 10
    seconds. ``checkpoint`` holds offsets, watermark and state: with the same
    path, a restarted job continues where the last one ended. A listener writes
    the metric rows; :func:`run_available` waits for it.
    """
    trigger = trigger or CONTINUOUS
    messages = feed.message_stream(spark, feed_dir, kafka_options, max_per_trigger)
    windows = collect_latest(feed.watermarked(valid_bars(messages)))
    windows = windows.observe(OBSERVED, F.sum(F.size("rows")).alias("records"), F.sum("received").alias("received"))
    name = f"indicators-{uuid.uuid4().hex[:12]}"
    metrics = BatchMetrics(spark, out_dir, name)
    spark.streams.addListener(metrics)
    main = (windows.writeStream.queryName(name).outputMode("update")
            .foreachBatch(indicator_batch(out_dir, publish_options, topics))
            .option("checkpointLocation", os.path.join(checkpoint, "indicators")).trigger(**trigger).start())
    _listeners[str(main.runId)] = metrics
    return [main, start_rejects(messages, out_dir, checkpoint, trigger)]


# Metric listeners by the run of their query.
_listeners: dict[str, BatchMetrics] = {}


def start_ingest(messages: DataFrame, out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Append the valid bars of the messages to a Parquet table."""
    return (valid_bars(messages).drop(ARRIVAL).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_dedup(messages: DataFrame, out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """The same without repeats (within the watermark)."""
    rows = feed.watermarked(valid_bars(messages)).drop(ARRIVAL).dropDuplicatesWithinWatermark(["ticker", "date"])
    return (rows.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_window_collect(messages: DataFrame, out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """20-day windows per ticker in update mode: every touched window is emitted whole, by batch."""
    def sink(df: DataFrame, batch_id: int) -> None:
        # Overwriting the batch's own folder makes a replayed batch idempotent.
        flatten_windows(df).write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
    windows = collect_latest(feed.watermarked(valid_bars(messages)))
    return (windows.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def latest_windows(emitted: DataFrame) -> DataFrame:
    """The latest emission of every window."""
    latest = Window.partitionBy("ticker", "window_start")
    return (emitted.withColumn("_last", F.max("batch_id").over(latest))
            .filter(F.col("batch_id") == F.col("_last")).drop("_last", "batch_id"))


def start_stateful(messages: DataFrame, out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Continuous indicators: each batch continues the series from the stored state.

    ``out/rows`` holds the rows by batch id, ``out/state`` the state by ticker
    (``streaming.state``: a batch reads and writes its own tickers' only).
    """
    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if ledger.is_committed(spark, out, batch_id):
            return
        with scratch_scope(spark):
            store = KeyedState(spark, os.path.join(out, "state"), STATE_SCHEMA, "ticker")
            seen = Observation()
            bars = materialize(df.observe(seen, F.collect_set(store.bucket()).alias("buckets")))
            touched = sorted(observed(seen).get("buckets") or ())
            if not touched:
                return
            rows, state, counts = continue_indicators(bars, store.read(batch_id, touched), bounded=True)
            rows.write.mode("overwrite").parquet(os.path.join(out, "rows", f"batch_id={batch_id}"))
            counts.write.mode("overwrite").parquet(os.path.join(out, "counts", f"batch_id={batch_id}"))
            store.write(batch_id, state)
            ledger.commit(spark, out, batch_id)
    bars = valid_bars(messages).select("date", "ticker", "close", ARRIVAL)
    return (bars.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start())
