import datetime as dt
import json

from pyspark.sql import functions as F

from candela.operators.compare import (indicator_accuracy, perf_summary, report,
                                       signal_agreement, signal_counts)
from candela.sinks import keyed
from candela.streaming.windows import collect_windows, flatten_windows


def test_window_bucket(spark):
    df = spark.createDataFrame([("T", dt.date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1.0, 1)],
                               "ticker string, date date, open double, high double, low double, "
                               "close double, adj_close double, volume long")
    r = flatten_windows(collect_windows(df)).first()
    assert (r.window_start, r.window_end) == (dt.date(2023, 12, 29), dt.date(2024, 1, 18))


def test_field_alignment_with_null(spark):
    rows = [("T", dt.date(2024, 1, d), o, 1.0, 1.0, c, c, 1) for d, o, c in
            [(2, None, 10.0), (3, 20.0, 11.0), (4, 30.0, 12.0)]]
    df = spark.createDataFrame(rows, "ticker string, date date, open double, high double, "
                                     "low double, close double, adj_close double, volume long")
    got = {r.date.day: (r.open, r.close) for r in flatten_windows(collect_windows(df)).collect()}
    assert got == {2: (None, 10.0), 3: (20.0, 11.0), 4: (30.0, 12.0)}


def test_upsert_twice_keeps_latest(spark):
    old = spark.createDataFrame([("d1", "T", "BATCH", 1.0), ("d2", "T", "BATCH", 2.0)],
                                "date string, ticker string, processing_type string, v double")
    new = spark.createDataFrame([("d2", "T", "BATCH", 20.0), ("d3", "T", "BATCH", 30.0)], old.schema)
    key = ["date", "ticker", "processing_type"]
    once = keyed.merge_latest(old, new, key)
    twice = keyed.merge_latest(once, new, key)
    assert sorted(map(tuple, twice.collect())) == [
        ("d1", "T", "BATCH", 1.0), ("d2", "T", "BATCH", 20.0), ("d3", "T", "BATCH", 30.0)]


def test_insert_if_absent_keeps_existing(spark):
    target = spark.createDataFrame([("d1", "T", 1.0)], "date string, ticker string, close double")
    stage = spark.createDataFrame([("d1", "T", 9.0), ("d2", "T", 2.0), ("d2", "T", 3.0)], target.schema)
    got = sorted(map(tuple, keyed.insert_if_absent(target, stage, ["date", "ticker"]).collect()))
    assert got[0] == ("d1", "T", 1.0) and len(got) == 2 and got[1][0] == "d2"


KEY = ["date", "ticker", "processing_type"]
TABLE = "date date, ticker string, processing_type string, v double"


def day(n):
    return dt.date(2024, 1, n)


def test_insert_keeps_the_first_staged_row(spark):
    target = spark.createDataFrame([], "d string, ticker string, close double, n int")
    stage = spark.createDataFrame([("d1", "T", 3.0, 2), ("d1", "T", 9.0, 1), (None, "T", 1.0, 1), (None, "T", 2.0, 2)],
                                  target.schema)
    got = keyed.insert_if_absent(target, stage, ["d", "ticker"], ["n"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("d1", "T", 9.0, 1), (None, "T", 1.0, 1)], key=str)
    again = keyed.insert_if_absent(got, stage, ["d", "ticker"], ["n"])
    assert again.count() == 2  # NULL keys are stored once


def test_first_load_and_later_loads_store_keys_once(spark, tmp_path):
    path = str(tmp_path / "ind")
    rows = [(day(1), "T", "BATCH", 1.0), (day(1), "T", "BATCH", 2.0), (day(2), None, "BATCH", 3.0)]
    for _ in range(2):
        keyed.upsert_parquet(spark, path, spark.createDataFrame(rows, TABLE), KEY)
        got = spark.read.parquet(path)
        assert sorted((str(r.ticker), float(r.v)) for r in got.collect()) == [("None", 3.0), ("T", 2.0)]
    assert dict(got.dtypes)["v"] == "decimal(16,6)" and got.filter("created_at IS NULL").count() == 0
    raw = str(tmp_path / "raw")
    for _ in range(2):
        keyed.insert_parquet(spark, raw, spark.createDataFrame(rows, TABLE), KEY)
        assert spark.read.parquet(raw).count() == 2


def test_signals_of_a_correction_replace_old_ones(spark, tmp_path):
    """SMA and MACD turn, RSI doesn't fire any more: nothing of the first run stays."""
    path = str(tmp_path / "sig")
    schema = "date date, ticker string, processing_type string, signal_source string, signal_type string"
    first = [(day(3), "T", "BATCH", s, "BUY") for s in ("SMA_CROSS", "RSI", "MACD")] + [(day(4), "T", "BATCH", "MACD", "BUY")]
    second = [(day(3), "T", "BATCH", s, "SELL") for s in ("SMA_CROSS", "MACD")]
    keyed.replace_parquet(spark, path, *(2 * (spark.createDataFrame(first, schema),)), KEY)
    new = spark.createDataFrame(second, schema)
    keyed.replace_parquet(spark, path, new, new, KEY)
    got = sorted((r.date.day, r.signal_source, r.signal_type) for r in spark.read.parquet(path).collect())
    assert got == [(3, "MACD", "SELL"), (3, "SMA_CROSS", "SELL"), (4, "MACD", "BUY")]


def test_a_corrected_batch_changes_stored_signals(spark, tmp_path):
    from candela.plans import batch
    out = str(tmp_path / "run")
    closes = [100.0 + (k * 13) % 17 for k in range(60)]
    schema = ("date date, ticker string, open double, high double, low double, close double, adj_close double, volume long")

    def rows(last):
        c = [*closes, last]
        return spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=k), "T", x, x, x, x, x, 1)
                                      for k, x in enumerate(c)], schema)
    seen = []
    for last in (200.0, 20.0):
        batch.run(spark, rows(last), out)
        sig = spark.read.parquet(out + "/trading_signals").filter(F.col("date") == dt.date(2024, 3, 1))
        seen.append(sorted((r.signal_source, r.signal_type) for r in sig.collect()))
    assert seen[0][-1] == ("SMA_CROSS", "BUY") and seen[1][-1] == ("SMA_CROSS", "SELL")
    assert ("MACD", "SELL") in seen[1] and ("MACD", "BUY") not in seen[1]


def test_batch_rejects_bad_bars_and_leaves_no_scratch(spark, tmp_path):
    import os

    from candela.plans import batch
    from candela.session import checkpoint_root
    schema = ("date date, ticker string, open double, high double, low double, close double, adj_close double, volume long")
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=k), "T", 1.0, 2.0, 0.5, 1.0 + k % 3, 1.0, 1) for k in range(30)]
    bad = [(None, "T", 1.0, 2.0, 0.5, 1.0, 1.0, 1), (day(9), None, 1.0, 2.0, 0.5, 1.0, 1.0, 1), (day(9), "T", 1.0, 0.1, 0.5, 1.0, 1.0, 1)]
    root = checkpoint_root(spark).removeprefix("file:") + "/candela"
    before = set(os.listdir(root)) if os.path.exists(root) else set()
    out = str(tmp_path / "run")
    metric = batch.run(spark, spark.createDataFrame(rows + bad, schema), out).first()
    assert json.loads(metric.details)["rejected_count"] == 3
    assert sorted(r.reason for r in spark.read.parquet(out + "/rejected_bars").collect()) == [
        "low_above_high", "not_null:date", "not_null:ticker"]
    assert set(os.listdir(root)) == before


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    import os
    path = str(tmp_path / "ind")
    rows = [(day(1), "T", "BATCH", 1.0), (day(1), "T", "STREAMING", 5.0), (dt.date(2024, 2, 1), "T", "BATCH", 7.0)]
    keyed.upsert_parquet(spark, path, spark.createDataFrame(rows, TABLE), KEY)
    files = lambda p: sorted(os.listdir(f"{path}/processing_type={p[0]}/month={p[1]}"))
    kept = [files(("BATCH", "2024-02")), files(("STREAMING", "2024-01"))]
    keyed.upsert_parquet(spark, path, spark.createDataFrame([(day(1), "T", "BATCH", 2.0)], TABLE), KEY)
    assert [files(("BATCH", "2024-02")), files(("STREAMING", "2024-01"))] == kept
    got = sorted((r.processing_type, float(r.v)) for r in spark.read.parquet(path).collect())
    assert got == [("BATCH", 2.0), ("BATCH", 7.0), ("STREAMING", 5.0)]


def test_csv_reader_leaves_the_schema_alone(spark, tmp_path):
    from candela.sources import files
    b = spark.createDataFrame([(day(2), "T", 1.0, 1.0, 1.0, 1.0, 1.0, 1)],
                              "date date, ticker string, open double, high double, low double, close double, "
                              "adj_close double, volume long")
    path = str(tmp_path / "csv")
    files.write_csv_bars(b, path)
    for _ in range(2):
        assert files.read_csv_bars(spark, path).first().ticker == "T"
    assert files.read_csv_bars(spark, path + "/ticker=T", "X").first().ticker == "X"


def test_report_keeps_nulls(spark, tmp_path):
    import glob

    from candela.operators.compare import REPORT_FIELDS
    from candela.sinks.report import write_report
    flat = spark.createDataFrame([tuple([None] * len(REPORT_FIELDS))], ", ".join(f"{c} double" for c in REPORT_FIELDS))
    write_report(flat, str(tmp_path / "r"))
    doc = json.loads(open(glob.glob(str(tmp_path / "r") + "/*.json")[0]).read())
    assert doc["batch_performance"] == {"total_time": None}


def test_long_runs_stay_in_the_summary(spark):
    from candela.operators.compare import processing_times
    rows = [("BATCH", "PROCESSING_TIME", 10.0), ("BATCH", "PROCESSING_TIME", 9000.0), ("BATCH", "OTHER", 1.0)]
    m = spark.createDataFrame(rows, "processing_type string, metric_name string, metric_value double")
    assert perf_summary(processing_times(m)).first().total_time == 9010.0
    assert processing_times(m, below=3600.0).count() == 1


def test_shared_folder_is_needed_off_local_masters(monkeypatch):
    import pytest

    from candela import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError):
        session.checkpoint_root(Session())


def test_empty_input_report(spark):
    empty_diffs = spark.createDataFrame([], "sma_diff double, rsi_diff double, macd_diff double")
    empty_sig = spark.createDataFrame([], "date string, processing_type string, signal_type string")
    empty_times = spark.createDataFrame([], "processing_type string, metric_value double")
    r = report(perf_summary(empty_times), indicator_accuracy(empty_diffs),
               signal_agreement(signal_counts(empty_sig))).first()
    assert r.stream_batch_count == 0
    assert r.avg_sma_diff is None and r.buy_agreement is None and r.stream_avg_time is None
