"""The batch job: bars -> indicators -> signals -> sinks, plus its run metric."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candela.functions.indicators import complete, with_indicators
from candela.functions.signals import signals
from candela.schemas import BATCH, INDICATOR_COLUMNS
from candela.session import materialize, observed, scratch_scope, together

INDICATOR_KEY = ["date", "ticker", "processing_type"]
INDICATOR_TABLE_COLUMNS = ["date", "ticker", "processing_type", "close", *INDICATOR_COLUMNS]


def indicator_rows(bars: DataFrame, processing_type: str = BATCH,
                   by: tuple[str, ...] = ("ticker",), bounded: bool = False) -> DataFrame:
    """Complete indicator rows (warm-up rows dropped) tagged with the processing type."""
    needed = dict.fromkeys([*by, "ticker", "date"])
    wide = with_indicators(bars.select(*needed, F.col("close").cast("double").alias("close")), by=by, bounded=bounded)
    return (complete(wide, ["close", *INDICATOR_COLUMNS])
            .withColumn("processing_type", F.lit(processing_type))
            .select(*INDICATOR_TABLE_COLUMNS))


def signal_rows(indicators: DataFrame) -> DataFrame:
    return signals(indicators)


def metric_row(spark: SparkSession, processing_type: str, seconds: float, window_size: str, details: dict) -> DataFrame:
    """One metric row: run time with a JSON detail document."""
    return spark.createDataFrame(
        [(processing_type, "PROCESSING_TIME", float(seconds), window_size, json.dumps(details))],
        "processing_type string, metric_name string, metric_value double, "
        "window_size string, details string",
    ).withColumn("execution_date", F.current_timestamp())


def run(spark: SparkSession, bars: DataFrame, out_dir: str) -> DataFrame:
    """Batch leg under ``out_dir``; returns the run metric row.

    Bars that break the contract go to ``rejected_bars`` with a reason; the
    others give indicators (keyed upsert) and signals (all signals of the
    touched dates are replaced, so a correction leaves none behind). Row counts
    are observed while the rows are written.
    """
    from candela.operators.quality import quarantine
    from candela.sinks.keyed import months, replace_parquet, upsert_parquet

    started = time.time()
    with scratch_scope(spark):
        valid, rejected = quarantine(bars)
        counted = Observation()
        rejected.observe(counted, F.count(F.lit(1)).alias("rejected")).write.mode("overwrite").parquet(
            f"{out_dir}/rejected_bars/leg=batch")
        rows = Observation()
        # Computed once, read by the upsert and the signals.
        ind = materialize(indicator_rows(valid).observe(rows, F.count(F.lit(1)).alias("records")))
        touched = months(ind)
        together(spark,
                 lambda: upsert_parquet(spark, f"{out_dir}/technical_indicators", ind, INDICATOR_KEY, touched),
                 lambda: replace_parquet(spark, f"{out_dir}/trading_signals", signal_rows(ind), ind, INDICATOR_KEY, touched))
        elapsed = time.time() - started
        metric = metric_row(spark, BATCH, elapsed, "FULL DATASET", {
            "record_count": observed(rows).get("records", 0), "rejected_count": observed(counted).get("rejected", 0), "processing_time_sec": elapsed})
        metric.write.mode("overwrite").parquet(f"{out_dir}/performance_metrics/run=batch-{uuid.uuid4().hex[:12]}")
    return metric
