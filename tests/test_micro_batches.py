"""Micro-batches: job count, versions of a bar, metrics, failures half-way, the trigger, state by key."""

import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from candela.plans import stream_job
from candela.session import list_names
from candela.sinks import ledger
from candela.streaming.state import KeyedState
from candela.streaming.stateful import STATE_SCHEMA
from test_streaming import as_set, days, message, send


def starter(spark, tmp_path, **options):
    feed, out, check = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "check")
    options = {"trigger": stream_job.AVAILABLE, **options}
    return feed, out, lambda: stream_job.start_indicator_job(spark, out, check, feed_dir=str(feed), **options)


def table(spark, out, name):
    return sorted(map(tuple, spark.read.parquet(f"{out}/{name}").drop("created_at").select(
        F.to_json(F.struct("*")).alias("row")).collect()))


def test_a_batch_takes_few_jobs_and_reads_its_windows_once(spark, tmp_path):
    feed, out, start = starter(spark, tmp_path)
    send(feed, "a/1", days(90))
    seen = []

    def watched():
        queries = start()
        seen.append(str(queries[0].runId))
        return queries
    stream_job.run_available(spark, watched)
    assert len(ledger.committed(spark, out)) == 1
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup(seen[0])) <= 8


@pytest.mark.parametrize("close", [60.0, 40.0])
def test_corrections_up_and_down_arrive(spark, tmp_path, close):
    """One in the same file, one in a later run while the window is open."""
    feed, out, start = starter(spark, tmp_path)
    lines = [json.loads(m) for m in days(37)]  # the last window is open, and full
    for k in lines:
        k.update(close=50.0, high=100.0, low=0.0)
    fix = {**lines[35], "close": close}
    send(feed, "a/1", [json.dumps(k) for k in lines] + [json.dumps(fix)])
    stream_job.run_available(spark, start)
    at = lambda k: float(spark.read.parquet(out + "/technical_indicators").filter(
        F.col("date") == dt.date(2024, 1, 1) + dt.timedelta(days=k)).first().close)
    assert at(35) == close and at(36) == 50.0
    send(feed, "b/1", [json.dumps({**lines[36], "close": close})])
    stream_job.run_available(spark, start)
    assert at(36) == close and at(35) == close


def test_metric_details_count_repeats_and_late_rows(spark, tmp_path):
    feed, out, start = starter(spark, tmp_path)
    send(feed, "a/1", days(50) + days(5, 45))
    stream_job.run_available(spark, start)
    send(feed, "b/1", days(3))           # their window is closed
    stream_job.run_available(spark, start)
    got = [json.loads(r.details) for r in spark.read.parquet(out + "/performance_metrics").collect()]
    got.sort(key=lambda d: d["batch_id"])
    assert [(d["record_count"], d["repeat_count"], d["late_count"] > 0) for d in got] == [(50, 5, False), (0, 0, True)]
    assert all(d["processing_time_ms"] > 0 for d in got) and len({d["batch_id"] for d in got}) == 2


def test_a_batch_that_stops_between_two_tables_is_run_again(spark, tmp_path, monkeypatch):
    lines = days(70)
    feed, out, start = starter(spark, tmp_path / "undisturbed")
    send(feed, "a/1", lines)
    stream_job.run_available(spark, start)
    feed, broken, start = starter(spark, tmp_path / "broken")
    send(feed, "a/1", lines)
    real = stream_job.replace_parquet

    def stop(*a, **k):
        raise RuntimeError("lost")
    monkeypatch.setattr(stream_job, "replace_parquet", stop)
    with pytest.raises(Exception, match="lost"):
        stream_job.run_available(spark, start)
    assert ledger.committed(spark, broken) == [] and os.path.exists(broken + "/technical_indicators")
    monkeypatch.setattr(stream_job, "replace_parquet", real)
    stream_job.run_available(spark, start)
    assert len(ledger.committed(spark, broken)) == 1
    for name in ("technical_indicators", "trading_signals"):
        assert table(spark, broken, name) == table(spark, out, name)
    text = lambda root: sorted(x for f in glob.glob(root + "/messages/*/*/*.txt") for x in open(f))
    assert text(broken) == text(out)


def test_a_committed_batch_is_not_run_twice(spark, tmp_path):
    out = str(tmp_path / "out")
    ledger.commit(spark, out, 4)
    windows = spark.createDataFrame([], "window struct<start:timestamp,end:timestamp>, ticker string, rows array<string>")
    stream_job.indicator_batch(out)(windows, 4)  # its columns are wrong: it isn't looked at
    assert ledger.committed(spark, out) == [4] and ledger.is_committed(spark, out, 4) and not ledger.is_committed(spark, out, 5)


def test_the_processing_time_trigger_runs_batches(spark, tmp_path):
    feed, out, start = starter(spark, tmp_path, trigger={"processingTime": "1 second"})
    send(feed, "a/1", days(40))
    queries = start()
    try:
        for name, lines in (("b/1", days(30, 40)), ("c/1", days(30, 70))):
            done = len(ledger.committed(spark, out))
            deadline = time.time() + 60
            while len(ledger.committed(spark, out)) == done and time.time() < deadline:
                time.sleep(0.2)
            assert len(ledger.committed(spark, out)) > done
            send(feed, name, lines)
        assert all(q.isActive for q in queries)
    finally:
        for q in queries:
            q.stop()


# ---------------------------------------------------------------------- state

def state(spark, tickers, value):
    rows = [(t, dt.datetime(2024, 1, 1 + k), float(value), *[float(value)] * 5) for t in tickers for k in range(3)]
    return spark.createDataFrame(rows, STATE_SCHEMA)


def closes(df):
    return {r.ticker: r.close for r in df.collect()}


def size(path):
    return sum(os.path.getsize(os.path.join(f, n)) for f, _, names in os.walk(path) for n in names if n.endswith(".parquet"))


def test_a_batch_writes_its_own_keys_only(spark, tmp_path):
    path = str(tmp_path / "state")
    store = KeyedState(spark, path, STATE_SCHEMA, "ticker", buckets=8)
    store.write(0, state(spark, [f"t{k}" for k in range(500)], 1))
    store.write(1, state(spark, ["t7"], 2))
    assert size(path + "/delta-1") < size(path + "/delta-0") / 5
    got = closes(store.read(2))
    assert len(got) == 500 and got["t7"] == 2.0 and got["t8"] == 1.0
    assert closes(store.read(1))["t7"] == 1.0 and store.read(0) is None  # what a batch that is run again reads
    bucket = state(spark, ["t7"], 2).select(store.bucket()).first()[0]
    part = store.read(2, [bucket])
    assert 0 < len(closes(part)) < 500 and closes(part)["t7"] == 2.0
    assert "PartitionFilters: [" in part._jdf.queryExecution().executedPlan().toString().replace("PartitionFilters: []", "")


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "state")
    store = KeyedState(spark, path, STATE_SCHEMA, "ticker", buckets=2, compact_every=3)
    for b in range(9):
        store.write(b, state(spark, [f"t{b % 4}", None], b))
        assert len(list_names(spark, path)) <= 6
        assert store.read(b) is None or set(closes(store.read(b))) == {*[f"t{k}" for k in range(min(b, 4))], None}
    got = closes(store.read(9))
    assert got == {"t0": 8.0, "t1": 5.0, "t2": 6.0, "t3": 7.0, None: 8.0}
    assert store.read(9).groupBy("ticker").count().filter("count <> 3").count() == 0
    assert any(n.startswith("base-") for n in list_names(spark, path))


def test_an_unfinished_delta_is_not_read(spark, tmp_path):
    path = str(tmp_path / "state")
    store = KeyedState(spark, path, STATE_SCHEMA, "ticker")
    store.write(0, state(spark, ["a"], 1))
    store.write(1, state(spark, ["a"], 2))
    os.remove(path + "/delta-1/_SUCCESS")
    assert closes(store.read(2)) == {"a": 1.0}


def test_stateful_run_again_after_a_stop(spark, tmp_path, monkeypatch):
    """The stop comes after the rows are written and before the state is."""
    feed, out, check = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "check")

    def start():
        from candela.streaming.feed import message_stream
        return stream_job.start_stateful(message_stream(spark, str(feed)), out, check, stream_job.AVAILABLE)
    send(feed, "a/1", days(30))
    stream_job.run_available(spark, start)
    send(feed, "b/1", days(30, 30) + days(4, 10) + [message(date="2024-02-10", ticker="U", close=3.0)])
    real = KeyedState.write
    monkeypatch.setattr(KeyedState, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        stream_job.run_available(spark, start)
    monkeypatch.setattr(KeyedState, "write", real)
    stream_job.run_available(spark, start)
    rows = spark.read.parquet(out + "/rows")
    assert rows.filter("ticker = 'T'").count() == rows.filter("ticker = 'T'").select("date").distinct().count() == 60
    assert rows.filter("ticker = 'U'").count() == 1
    counts = {(r.batch_id, r.name): r.n for r in spark.read.parquet(out + "/counts").collect()}
    assert sorted(counts.values()) == [30, 30, 31, 35]
