"""Registered queries against their DuckDB oracle SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare

FAST = ["sma", "ema", "macd", "rsi", "bollinger", "indicators_complete", "signals_long",
        "batch_project_filter_sort", "insert_if_absent", "publish_bar_json",
        "publish_indicator_json", "json_roundtrip", "window_bucket", "window_collect_flatten",
        "quality_violations", "metrics_filtered", "perf_summary", "compare_indicators",
        "signal_counts", "ingest_csv_bars", "scan_jdbc", "upsert_indicators", "append_signals_dedup",
        "run_metrics", "quarantine_bars", "stream_window_signals", "stream_metrics", "stream_late_rows",
        "stream_indicators_stateful", "stream_window_indicators", "stream_window_collect",
        "latest_signals_limit", "metric_values", "insert_first_arrival", "quarantine_conflicts", "gated_indicators",
        "stream_corrections", "stream_batch_details"]


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    rows_only = {n for n in set(q) - set(o)}
    assert all(n == "pipeline" or n.startswith("op") for n in rows_only), rows_only


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"signal_type", "signal_strength", "signal_source"} <= set(df.columns)
