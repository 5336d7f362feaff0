"""Batch-versus-stream comparison: indicator differences, signal agreement,
run metrics and the summary report. Joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.schemas import BATCH, STREAMING

# Metric name of run times.
PROCESSING_TIME = "PROCESSING_TIME"


def compare_indicators(indicators: DataFrame) -> DataFrame:
    """Self-join of STREAMING and BATCH indicators on (date, ticker) with the
    absolute differences of SMA-20, RSI-14 and MACD. The type filters are
    pushed below the join."""
    s = indicators.filter(F.col("processing_type") == STREAMING).alias("s")
    b = indicators.filter(F.col("processing_type") == BATCH).alias("b")
    # The result names of this comparison.
    return (s.join(b, (F.col("s.date") == F.col("b.date")) & (F.col("s.ticker") == F.col("b.ticker")))
             .select(F.col("s.date").alias("date"), F.col("s.ticker").alias("ticker"),
                     F.col("s.sma_20").alias("stream_sma20"), F.col("b.sma_20").alias("batch_sma20"),
                     F.abs(F.col("s.sma_20") - F.col("b.sma_20")).alias("sma_diff"),
                     F.col("s.rsi_14").alias("stream_rsi"), F.col("b.rsi_14").alias("batch_rsi"),
                     F.abs(F.col("s.rsi_14") - F.col("b.rsi_14")).alias("rsi_diff"),
                     F.col("s.macd").alias("stream_macd"), F.col("b.macd").alias("batch_macd"),
                     F.abs(F.col("s.macd") - F.col("b.macd")).alias("macd_diff")))


def indicator_accuracy(diffs: DataFrame) -> DataFrame:
    """Mean absolute differences (NULLs skipped; NULL for no rows)."""
    return diffs.agg(F.avg("sma_diff").alias("avg_sma_diff"),
                     F.avg("rsi_diff").alias("avg_rsi_diff"),
                     F.avg("macd_diff").alias("avg_macd_diff"))


def signal_counts(signals: DataFrame) -> DataFrame:
    """Per date: number of BUY/SELL/HOLD signals of each processing type."""
    def n(kind: str, sig: str):
        return F.count_if((F.col("processing_type") == kind) & (F.col("signal_type") == sig))
    return signals.groupBy("date").agg(
        n(STREAMING, "BUY").alias("stream_buy"), n(BATCH, "BUY").alias("batch_buy"),
        n(STREAMING, "SELL").alias("stream_sell"), n(BATCH, "SELL").alias("batch_sell"),
        n(STREAMING, "HOLD").alias("stream_hold"), n(BATCH, "HOLD").alias("batch_hold"))


def signal_agreement(counts: DataFrame) -> DataFrame:
    """Percent of dates on which both types emitted the same number of each signal."""
    def pct(a: str, b: str):
        return F.avg(F.when(F.col(a) == F.col(b), 1.0).otherwise(0.0)) * 100.0
    return counts.agg(pct("stream_buy", "batch_buy").alias("buy_agreement"),
                      pct("stream_sell", "batch_sell").alias("sell_agreement"),
                      pct("stream_hold", "batch_hold").alias("hold_agreement"))


def processing_times(metrics: DataFrame, below: float | None = None) -> DataFrame:
    """Run-time metrics; with ``below`` only those under so many seconds (pushed down)."""
    times = metrics.filter(F.col("metric_name") == PROCESSING_TIME)
    return times if below is None else times.filter(F.col("metric_value") < below)


def perf_summary(times: DataFrame) -> DataFrame:
    """Mean, total and count of run times per processing type."""
    return times.groupBy("processing_type").agg(
        F.avg("metric_value").alias("avg_time"),
        F.sum("metric_value").alias("total_time"),
        F.count(F.lit(1)).alias("run_count"))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """One-row aggregate -> (name, value) rows."""
    pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS (name, value)")


REPORT_FIELDS = ["stream_avg_time", "stream_total_time", "stream_batch_count", "batch_total_time",
                 "avg_sma_diff", "avg_rsi_diff", "avg_macd_diff",
                 "buy_agreement", "sell_agreement", "hold_agreement"]


def report(summary: DataFrame, accuracy: DataFrame, agreement: DataFrame) -> DataFrame:
    """One-row report: stream and batch run times, accuracy, agreement.

    The parts are one-row aggregates; they are stacked into (name, value)
    rows and pivoted back in one aggregation (no cross join). A missing
    side gives NULL values and a stream batch count of 0.
    """
    def of(kind: str, c: str):
        return F.max(F.when(F.col("processing_type") == kind, F.col(c)))
    perf = summary.agg(of(STREAMING, "avg_time").alias("stream_avg_time"),
                       of(STREAMING, "total_time").alias("stream_total_time"),
                       of(STREAMING, "run_count").alias("stream_batch_count"),
                       of(BATCH, "total_time").alias("batch_total_time"))
    parts = (_long(perf, REPORT_FIELDS[:4])
             .unionByName(_long(accuracy, REPORT_FIELDS[4:7]))
             .unionByName(_long(agreement, REPORT_FIELDS[7:])))
    out = parts.agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(c) for c in REPORT_FIELDS])
    return out.withColumn("stream_batch_count",
                          F.coalesce(F.col("stream_batch_count").cast("bigint"), F.lit(0).cast("bigint")))


def nested_report(flat: DataFrame) -> DataFrame:
    """The report as four nested objects (the JSON document layout)."""
    return flat.select(
        F.struct(F.col("stream_avg_time").alias("avg_time"),
                 F.col("stream_total_time").alias("total_time"),
                 F.col("stream_batch_count").alias("batch_count")).alias("streaming_performance"),
        F.struct(F.col("batch_total_time").alias("total_time")).alias("batch_performance"),
        F.struct("avg_sma_diff", "avg_rsi_diff", "avg_macd_diff").alias("indicator_accuracy"),
        F.struct("buy_agreement", "sell_agreement", "hold_agreement").alias("signal_agreement"))
