"""Registered queries: ``name -> f(spark, data_dir) -> DataFrame``.

Every query reads the driver's tables of ``data_dir`` (daily bars come from
``orders``, run metrics from ``events``) and runs over whole tables. Double
results are rounded to 4 decimals so that an independent engine computing the
same values compares equal (no result here sits on a 4-decimal tie).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions import indicators as I
from candela.functions.signals import signals
from candela.operators import compare as C
from candela.operators.quality import (BAR_KEY, BAR_NOT_NULL, INDICATOR_KEY, INDICATOR_NOT_NULL,
                                       SIGNAL_NOT_NULL, quarantine, violations)
from candela.fixtures import Replay, metrics_from_events, restarted_indicator_rows
from candela.plans import stream_job
from candela.plans.batch import INDICATOR_KEY, INDICATOR_TABLE_COLUMNS, indicator_rows
from candela.schemas import (BAR_COLUMNS, BAR_MESSAGE, INDICATOR_COLUMNS, PRICE_DECIMAL, STREAMING,
                             STRENGTH_DECIMAL)
from candela.session import materialize, prepare, scratch_path
from candela.sinks import keyed, publish
from candela.sources import arrival, files, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DIGITS = 4
# The ticker the reference's batch job selects by name; here one of the bar tickers.
SELECTED_TICKER = "1-URGENT"


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def bars(spark: SparkSession, data_dir: str) -> DataFrame:
    prepare(spark)
    return tables.daily_bars(spark, data_dir)


def closes(spark: SparkSession, data_dir: str) -> DataFrame:
    """What indicators read of the bars, as a stored stage (they read it more than once)."""
    return materialize(bars(spark, data_dir).select("date", "ticker", "close"))


def settled_bars(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bars of fulfilled orders only: an earlier, partial load of the same feed."""
    prepare(spark)
    orders = tables.table(spark, data_dir, "orders").filter(F.col("o_orderstatus") == "F")
    from candela.operators.bars import daily_bars_from_orders
    return daily_bars_from_orders(orders)


# ---------------------------------------------------------------- indicators

@query("sma")
def q_sma(spark, d):
    return rounded(I.sma(closes(spark, d)).select("date", "ticker", "close", "sma_5", "sma_10", "sma_20"))


@query("rolling_std")
def q_rolling_std(spark, d):
    return rounded(I.rolling_std(closes(spark, d), 20).select("date", "ticker", "close", "std_20"))


@query("price_delta")
def q_price_delta(spark, d):
    return rounded(I.delta(closes(spark, d)).select("date", "ticker", "close", "delta"))


@query("ema")
def q_ema(spark, d):
    return rounded(I.ema(closes(spark, d), (12, 26)).select("date", "ticker", "close", "ema_12", "ema_26"))


@query("wilder_avg")
def q_wilder(spark, d):
    return rounded(I.wilder_avg(closes(spark, d), 14).select("date", "ticker", "avg_gain", "avg_loss"))


@query("macd")
def q_macd(spark, d):
    return rounded(I.macd(closes(spark, d)).select("date", "ticker", "macd", "macd_signal", "macd_histogram"))


@query("rsi")
def q_rsi(spark, d):
    return rounded(I.rsi(closes(spark, d), 14).select("date", "ticker", "rsi_14"))


@query("bollinger")
def q_bollinger(spark, d):
    return rounded(I.bollinger(closes(spark, d)).select(
        "date", "ticker", "bollinger_upper", "bollinger_middle", "bollinger_lower"))


@query("indicators_wide")
def q_wide(spark, d):
    return rounded(I.with_indicators(closes(spark, d)).select("date", "ticker", "close", *INDICATOR_COLUMNS))


@query("indicators_complete")
def q_complete(spark, d):
    return rounded(indicator_rows(closes(spark, d)))


@query("signals_long")
def q_signals(spark, d):
    return rounded(signals(indicator_rows(closes(spark, d))))


def settled_closes(spark: SparkSession, data_dir: str) -> DataFrame:
    return materialize(settled_bars(spark, data_dir).select("date", "ticker", "close"))


# ------------------------------------------------------------ sources / SQL

@query("batch_project_filter_sort")
def q_project_filter_sort(spark, d):
    bars(spark, d).createOrReplaceTempView("daily_bars")
    return spark.sql(f"SELECT {', '.join(BAR_COLUMNS)} FROM daily_bars WHERE ticker = :ticker ORDER BY date",
                     args={"ticker": SELECTED_TICKER})


@query("latest_indicators_limit")
def q_latest_limit(spark, d):
    return rounded(indicator_rows(closes(spark, d)).orderBy(F.col("date").desc(), "ticker").limit(10))


@query("latest_signals_limit")
def q_latest_signals(spark, d):
    return rounded(signals(indicator_rows(closes(spark, d)))
                   .orderBy(F.col("date").desc(), "ticker", "signal_rank").limit(10))


@query("metric_values")
def q_metric_values(spark, d):
    return rounded(run_metrics_table(spark, d).select("processing_type", "metric_name", "metric_value"))


@query("ingest_csv_bars")
def q_ingest_csv(spark, d):
    path = scratch_path(spark, "csv-bars")
    files.write_csv_bars(bars(spark, d), path)
    return files.read_csv_bars(spark, path)


# In-process database (no server, no port); on a cluster the URL names a shared database.
JDBC_URL = "jdbc:derby:memory:candela;create=true"
JDBC_PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@query("scan_jdbc")
def q_scan_jdbc(spark, d):
    # The in-process database would otherwise write derby.log into the working directory.
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file", os.devnull)
    b = bars(spark, d).withColumn("day", F.datediff("date", F.lit("1970-01-01")))
    files.write_jdbc(b, JDBC_URL, "raw_stock_data", "ticker VARCHAR(32)", JDBC_PROPS)
    lo_hi = b.agg(F.min("day"), F.max("day")).first()
    scanned = files.read_jdbc(spark, JDBC_URL, "raw_stock_data", "day", lo_hi[0], lo_hi[1] + 1,
                              8, JDBC_PROPS)
    return scanned.select(*BAR_COLUMNS)


# ------------------------------------------------------------------ sinks

@query("insert_if_absent")
def q_insert_if_absent(spark, d):
    target = settled_bars(spark, d)
    return keyed.insert_if_absent(target, bars(spark, d), ["date", "ticker"])


@query("insert_first_arrival")
def q_insert_first_arrival(spark, d):
    """Three files of bars arrive: a partial load, the whole with other prices, the partial one again with others.

    The first bar of a key to arrive is stored, though its row is neither the least nor the greatest.
    """
    folder, path = scratch_path(spark, "staged-bars"), scratch_path(spark, "stored-bars")
    partial, whole = settled_bars(spark, d), bars(spark, d)
    for k, load in enumerate([partial, _repriced(whole, 2.0), _repriced(partial, 0.5)]):
        load.write.parquet(os.path.join(folder, f"load={k}"))
    stage = arrival.of_files(spark.read.parquet(folder)).drop("load")
    keyed.insert_parquet(spark, path, stage, ["date", "ticker"])
    keyed.insert_parquet(spark, path, _repriced(whole, 3.0), ["date", "ticker"])  # all there: nothing is added
    return rounded(spark.read.parquet(path).select(*BAR_COLUMNS).withColumns({c: F.col(c).cast("double") for c in PRICES}))


@query("upsert_indicators")
def q_upsert(spark, d):
    existing = indicator_rows(closes(spark, d))
    update = indicator_rows(settled_closes(spark, d))
    return rounded(keyed.merge_latest(existing, update, ["date", "ticker", "processing_type"]))


@query("append_signals_dedup")
def q_append_dedup(spark, d):
    """Two different batches: a partial load, then the corrected whole; each replaces the signals of its keys."""
    whole = closes(spark, d)
    stored = materialize(signals(restarted_indicator_rows(whole)))
    for batch in (settled_closes(spark, d), whole):
        ind = materialize(indicator_rows(batch))
        stored = materialize(keyed.replace_keys(stored, signals(ind), ind, INDICATOR_KEY))
    return rounded(stored)


def _repriced(df: DataFrame, factor: float) -> DataFrame:
    return df.withColumns({c: F.col(c) * factor for c in PRICES})


def exact(df: DataFrame, columns: list[str], kind: T.DecimalType, digits: int | None = None) -> DataFrame:
    """Columns as decimals, so that their text is the same in any engine."""
    return df.withColumns({c: (F.col(c) if digits is None else F.round(c, digits)).cast(kind) for c in columns})


PRICES = ["open", "high", "low", "close", "adj_close"]


@query("publish_bar_json")
def q_pub_bars(spark, d):
    return publish.bar_messages(exact(bars(spark, d), PRICES, PRICE_DECIMAL))


@query("publish_indicator_json")
def q_pub_ind(spark, d):
    return publish.indicator_messages(exact(indicator_rows(closes(spark, d)), INDICATOR_COLUMNS, PRICE_DECIMAL, DIGITS))


@query("publish_signal_json")
def q_pub_sig(spark, d):
    return publish.signal_messages(exact(signals(indicator_rows(closes(spark, d))), ["signal_strength"], STRENGTH_DECIMAL))


# --------------------------------------------------------- scalar functions

@query("json_roundtrip")
def q_json_roundtrip(spark, d):
    msg = bars(spark, d).select(F.to_json(F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "ticker", "open", "high", "low",
        "close", "adj_close", "volume")).alias("value"))
    parsed = msg.select(F.from_json("value", BAR_MESSAGE).alias("data")).select("data.*")
    return parsed.withColumn("date", F.to_date("date", "yyyy-MM-dd")).select(*BAR_COLUMNS)


def _bucketed(df: DataFrame) -> DataFrame:
    w = F.window(F.col("date").cast("timestamp"), "20 days")
    return df.withColumn("window", w)


@query("window_bucket")
def q_window_bucket(spark, d):
    return (_bucketed(bars(spark, d))
            .select("date", "ticker", F.col("window.start").cast("date").alias("window_start"),
                    F.col("window.end").cast("date").alias("window_end")))


@query("window_collect_flatten")
def q_window_collect(spark, d):
    from candela.streaming.windows import collect_windows, flatten_windows
    return flatten_windows(collect_windows(bars(spark, d)))


# ---------------------------------------------------------------- quality

@query("quality_violations")
def q_quality(spark, d):
    b = materialize(bars(spark, d))
    hourly = materialize(tables.hourly_bars(spark, d).withColumnRenamed("time", "date"))
    ind = materialize(indicator_rows(b))
    return (violations(b, "raw_stock_data", BAR_NOT_NULL, BAR_KEY)
            .unionByName(violations(hourly, "hourly_bars", BAR_NOT_NULL, BAR_KEY))
            .unionByName(violations(ind, "technical_indicators", INDICATOR_NOT_NULL, INDICATOR_KEY))
            .unionByName(violations(signals(ind), "trading_signals", SIGNAL_NOT_NULL)))


def _conflicting_files(spark, d) -> DataFrame:
    """Bars as CSV files in two loads. By the day's number modulo 11: 1 no number as close at first and the bar
    later, 2 an infinite high, 3 and 7 a second bar with higher and lower prices, 5 the same bar again."""
    path = scratch_path(spark, "conflicting-bars")
    b = bars(spark, d).withColumn("kind", F.pmod(F.datediff("date", F.lit("1970-01-01")), F.lit(11)))
    first = b.withColumns({"close": F.when(F.col("kind") == 1, F.lit(float("nan"))).otherwise(F.col("close")),
                           "high": F.when(F.col("kind") == 2, F.lit(float("inf"))).otherwise(F.col("high"))})
    factor = F.when(F.col("kind") == 3, 1.5).when(F.col("kind") == 7, 0.5).otherwise(1.0)
    second = b.filter("kind IN (1, 3, 5, 7)").withColumns({c: F.col(c) * factor for c in PRICES})
    for k, load in enumerate([first, second]):
        files.write_csv_bars(load.drop("kind"), os.path.join(path, f"load={k}"))
    return files.read_csv_bars(spark, path, arrival=True)


@query("quarantine_conflicts")
def q_quarantine_conflicts(spark, d):
    valid, rejected = quarantine(_conflicting_files(spark, d))
    return (rejected.groupBy("reason").agg(F.count("*").alias("rows"))
            .unionByName(valid.groupBy().agg(F.count("*").alias("rows")).select(F.lit("valid").alias("reason"), "rows")))


@query("gated_indicators")
def q_gated_indicators(spark, d):
    """The batch job over the same files: later rows have the values of undisturbed bars."""
    from candela.plans import batch
    out = scratch_path(spark, "gated-run")
    batch.run(spark, _conflicting_files(spark, d), out)
    return _stored_indicators(spark, out)


# ---------------------------------------------------------------- compare

def both_indicator_types(spark, d) -> DataFrame:
    b = closes(spark, d)
    return indicator_rows(b).unionByName(restarted_indicator_rows(b))


def both_signal_types(spark, d) -> DataFrame:
    return signals(both_indicator_types(spark, d))


@query("compare_indicators")
def q_compare(spark, d):
    return rounded(C.compare_indicators(both_indicator_types(spark, d))).orderBy("date", "ticker")


@query("indicator_accuracy")
def q_accuracy(spark, d):
    return rounded(C.indicator_accuracy(C.compare_indicators(both_indicator_types(spark, d))))


@query("signal_counts")
def q_signal_counts(spark, d):
    return C.signal_counts(both_signal_types(spark, d)).orderBy("date")


@query("signal_agreement")
def q_agreement(spark, d):
    return rounded(C.signal_agreement(C.signal_counts(both_signal_types(spark, d))))


def run_metrics_table(spark, d) -> DataFrame:
    prepare(spark)
    return metrics_from_events(tables.table(spark, d, "events"))


# The limit of the filtered metric report; the summary and the comparison take all runs.
PLAUSIBLE_SECONDS = 3600.0


@query("metrics_filtered")
def q_metrics_filtered(spark, d):
    return rounded(C.processing_times(run_metrics_table(spark, d), below=PLAUSIBLE_SECONDS)
                   .orderBy("execution_date", "processing_type", "details"))


@query("perf_summary")
def q_perf_summary(spark, d):
    return rounded(C.perf_summary(C.processing_times(run_metrics_table(spark, d))))


@query("comparison_report")
def q_report(spark, d):
    summary = C.perf_summary(C.processing_times(run_metrics_table(spark, d)))
    ind = materialize(both_indicator_types(spark, d))      # read by both halves below
    accuracy = C.indicator_accuracy(C.compare_indicators(ind))
    agreement = C.signal_agreement(C.signal_counts(signals(ind)))
    return rounded(C.report(summary, accuracy, agreement))


# -------------------------------------------------------------- streaming

def _stream_bars(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("date")).select(*BAR_COLUMNS)


def _replayed(spark, d, name: str, start, **options) -> Replay:
    """The bars as deliveries through the query that ``start(messages, out, checkpoint, trigger)`` starts."""
    run = Replay(spark, name)
    run.run(bars(spark, d), lambda: start(run.messages(), run.out, run.checkpoint, stream_job.AVAILABLE), **options)
    return run


@query("stream_json_ingest")
def q_stream_ingest(spark, d):
    return _stream_bars(spark.read.parquet(_replayed(spark, d, "ingest", stream_job.start_ingest).out))


@query("stream_dedup")
def q_stream_dedup(spark, d):
    """Every delivery arrives twice."""
    return _stream_bars(spark.read.parquet(_replayed(spark, d, "dedup", stream_job.start_dedup, copies=2).out))


WINDOW_ROW = ["date", "ticker", "window_start", "window_end", "open", "high", "low", "close",
              "adj_close", "volume"]


def _window_rows(spark, d, **options) -> DataFrame:
    run = _replayed(spark, d, "windows", stream_job.start_window_collect, **options)
    return stream_job.latest_windows(spark.read.parquet(run.out)).select(*WINDOW_ROW)


@query("stream_window_collect")
def q_stream_windows(spark, d):
    """Bars that are sent twice are in their window once."""
    return _window_rows(spark, d, copies=2)


@query("stream_late_rows")
def q_stream_late(spark, d):
    """After the last delivery, the first period arrives again with other prices. Its
    windows are closed, so the watermark drops all of these rows."""
    late = bars(spark, d).withColumns({c: F.col(c) * 2 + 1 for c in PRICES})
    return _window_rows(spark, d, late=late)


def _stream_job(spark, d, **options) -> str:
    run = Replay(spark, "indicator-job")
    run.run(bars(spark, d), lambda: stream_job.start_indicator_job(
        spark, run.out, run.checkpoint, feed_dir=run.feed, trigger=stream_job.AVAILABLE), **options)
    return run.out


@query("stream_corrections")
def q_stream_corrections(spark, d):
    """Each delivery sends its bars and then corrects them, up on even days and down on odd ones."""
    return _window_rows(spark, d, corrected=_corrected(bars(spark, d)))


def _corrected(b: DataFrame) -> DataFrame:
    even = F.pmod(F.datediff("date", F.lit("1970-01-01")), F.lit(2)) == 0
    return b.withColumns({c: F.col(c) * F.when(even, 1.5).otherwise(0.5) for c in PRICES})


def _stored_indicators(spark, out: str) -> DataFrame:
    stored = spark.read.parquet(os.path.join(out, "technical_indicators"))
    # Rounded as the decimals that are stored.
    return stored.select(*[F.round(c, 3).cast("double").alias(c) if c in ("close", *INDICATOR_COLUMNS) else F.col(c)
                           for c in INDICATOR_TABLE_COLUMNS])


@query("stream_window_indicators")
def q_stream_window_ind(spark, d):
    return _stored_indicators(spark, _stream_job(spark, d))


@query("stream_window_signals")
def q_stream_window_sig(spark, d):
    stored = spark.read.parquet(os.path.join(_stream_job(spark, d), "trading_signals"))
    return stored.select("date", "ticker", "processing_type", "signal_rank", "signal_type",
                         F.col("signal_strength").cast("double").alias("signal_strength"), "signal_source", "description")


@query("stream_indicators_stateful")
def q_stream_stateful(spark, d):
    from candela.functions.indicators import complete
    run = _replayed(spark, d, "stateful", stream_job.start_stateful, copies=2)
    out = complete(spark.read.parquet(os.path.join(run.out, "rows")), ["close", *INDICATOR_COLUMNS])
    return rounded(out.withColumn("date", F.col("date").cast("date")).withColumn("processing_type", F.lit(STREAMING))
                   .select(*INDICATOR_TABLE_COLUMNS))


def _metric_facts(metrics: DataFrame) -> DataFrame:
    """What of a run metric doesn't depend on the clock."""
    return metrics.select("processing_type", "metric_name", "window_size",
                          F.get_json_object("details", "$.record_count").cast("long").alias("record_count"),
                          (F.col("metric_value") > 0).alias("timed"))


@query("stream_metrics")
def q_stream_metrics(spark, d):
    """One metric row for each micro-batch with rows: the bars pooled in its windows."""
    return _metric_facts(spark.read.parquet(os.path.join(_stream_job(spark, d), "performance_metrics")))


@query("stream_batch_details")
def q_stream_batch_details(spark, d):
    """The details of each micro-batch: all bars are sent twice, and those of the first period again at the end, too late."""
    out = _stream_job(spark, d, copies=2, late=bars(spark, d))
    details = F.from_json("details", "batch_id long, record_count long, processing_time_ms double, "
                                     "repeat_count long, late_count long")
    read = spark.read.parquet(os.path.join(out, "performance_metrics")).select("metric_value", details.alias("of"))
    return read.select(F.rank().over(Window.orderBy("of.batch_id")).cast("long").alias("batch"), "of.record_count",
                       "of.repeat_count", (F.col("of.late_count") > 0).alias("late"),
                       (F.abs(F.col("metric_value") - F.col("of.processing_time_ms") / 1000) < 1e-6).alias("timed"))


@query("run_metrics")
def q_run_metrics(spark, d):
    from candela.plans import batch
    return _metric_facts(batch.run(spark, bars(spark, d), scratch_path(spark, "batch-run")))


@query("quarantine_bars")
def q_quarantine(spark, d):
    """Bars with injected faults as messages: bad dates, missing fields, wrong order, no JSON, repeats."""
    from candela.sinks.publish import bar_messages
    kind = F.pmod(F.datediff("date", F.lit("1970-01-01")), F.lit(11))
    b = bars(spark, d)
    faulty = b.withColumns({
        "close": F.when(kind != 1, F.col("close")), "ticker": F.when(kind != 2, F.col("ticker")),
        "low": F.when(kind == 3, F.col("high") + 1).otherwise(F.col("low"))})
    sent = bar_messages(faulty).withColumn("date", F.to_date(F.regexp_extract("value", '"date":"([^"]*)"', 1)))
    messages = sent.select(
        F.when(kind == 4, F.regexp_replace("value", '"date":"', '"date":"no '))
         .when(kind == 5, F.concat(F.lit("{"), F.col("value"))).otherwise(F.col("value")).alias("value"))
    valid = stream_job.valid_bars(messages).groupBy().agg(F.count("*").alias("rows"))
    reasons = stream_job.rejected_messages(messages).groupBy("reason").agg(F.count("*").alias("rows"))
    return valid.select(F.lit("valid").alias("reason"), "rows").unionByName(reasons)
