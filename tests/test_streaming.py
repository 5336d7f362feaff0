import glob
import json

import pytest
from pyspark.sql import functions as F

from candela.fixtures import Replay
from candela.plans import stream_job
from candela.plans.queries import REGISTRY, bars
from conftest import SF_SMALL


def as_set(df, cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_duplicate_feed_gives_rows_once(spark):
    b = bars(spark, SF_SMALL)
    got = REGISTRY["stream_dedup"](spark, SF_SMALL)
    cols = ["date", "ticker", "close"]
    assert got.count() == b.count()
    assert as_set(got, cols) == as_set(b, cols)


def test_late_rows_are_dropped_by_watermark(spark):
    b = bars(spark, SF_SMALL)
    run = Replay(spark, "late")
    run.run(b, lambda: stream_job.start_window_collect(run.messages(), run.out, run.checkpoint, stream_job.AVAILABLE),
            late=b.withColumn("close", F.col("close") * 2))
    assert stream_job.dropped_late_rows(run.log.progress) > 0
    out = stream_job.latest_windows(spark.read.parquet(run.out))
    assert as_set(out, ["date", "ticker", "close"]) == as_set(b, ["date", "ticker", "close"])


def message(date="2024-01-02", ticker="T", close=1.0, **more):
    body = {"date": date, "ticker": ticker, "open": 1.0, "high": 2.0, "low": 0.5, "close": close, "adj_close": 1.0, "volume": 3}
    return json.dumps({**body, **more})


BAD = ["no json", "{", message(date="soon"), message(date=None), message(close=None), message(high=0.1),
       message(volume="many"), "", "[1]"]


def test_bad_messages_are_rejected_with_their_text(spark):
    sent = [message(), *BAD]
    df = spark.createDataFrame([(m,) for m in sent], "value string")
    assert stream_job.valid_bars(df).count() == 1
    got = stream_job.rejected_messages(df).collect()
    assert sorted(r.raw_message for r in got) == sorted(BAD)
    assert {r.reason for r in got} >= {"not_null:date", "not_null:close", "not_null:volume", "low_above_high"}


def days(n, start=0, ticker="T"):
    import datetime as dt
    return [message(date=str(dt.date(2024, 1, 1) + dt.timedelta(days=start + k)), ticker=ticker, close=10.0 + (k * 7) % 11,
                    high=50.0) for k in range(n)]


def send(folder, name, lines):
    path = folder / name
    path.mkdir(parents=True)
    (path / "m.txt").write_text("\n".join(lines) + "\n")


def test_job_writes_publishes_and_continues_after_a_restart(spark, tmp_path):
    feed, out, check = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "check")

    def start():
        return stream_job.start_indicator_job(spark, out, check, feed_dir=str(feed), trigger=stream_job.AVAILABLE,
                                              max_per_trigger=5)
    send(feed, "a/1", days(60) + BAD)
    stream_job.run_available(spark, start)
    first = spark.read.parquet(out + "/performance_metrics").count()
    send(feed, "b/1", days(40, 60) + days(3, 60))
    stream_job.run_available(spark, start)       # same checkpoint: only the new file is read
    stream_job.run_available(spark, start)       # nothing new: no batch, no metric
    metrics = spark.read.parquet(out + "/performance_metrics")
    assert first >= 1 and metrics.count() == first + 1
    ind = spark.read.parquet(out + "/technical_indicators")
    assert ind.count() == ind.select("date", "ticker").distinct().count() > 0
    assert dict(ind.dtypes)["sma_20"] == "decimal(16,6)" and ind.filter("created_at IS NULL").count() == 0
    sig = spark.read.parquet(out + "/trading_signals")
    assert as_set(sig, ["date"]) <= as_set(ind, ["date"])
    assert spark.read.parquet(out + "/rejected_messages").count() == len(BAD)
    lines = [json.loads(x) for f in glob.glob(out + "/messages/indicators/*/*.txt") for x in open(f)]
    assert len(lines) >= ind.count() and {"date", "ticker", "rsi_14"} <= set(lines[0])


def test_kafka_options_reach_reader(monkeypatch):
    from candela.streaming import feed

    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **more):
            self.seen.update(more)
            return self

        def load(self):
            return self

        def select(self, *columns):
            return self

    class Session:
        readStream = Reader()
    monkeypatch.setattr(feed.F, "col", lambda c: pytest.importorskip("unittest.mock").MagicMock())
    monkeypatch.setattr(feed, "arrival", lambda *parts: None)
    monkeypatch.setattr(feed.F, "concat_ws", lambda *parts: None)
    s = Session()
    feed.message_stream(s, kafka_options={"kafka.bootstrap.servers": "h:1", "subscribe": "bars"}, max_per_trigger=9)
    assert s.readStream.seen == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "bars",
                                 "maxOffsetsPerTrigger": "9"}


@pytest.mark.parametrize("cuts", [(1,), (2, 5, 6), (25, 26, 70)])
@pytest.mark.parametrize("bounded", [False, True])
def test_continued_indicators_equal_batch(spark, tmp_path, cuts, bounded):
    """One ticker holds most rows; batches hold repeats, late rows, a NULL close and new tickers."""
    import datetime as dt

    import numpy as np

    from candela.functions.indicators import with_indicators
    from candela.streaming.state import KeyedState
    from candela.streaming.stateful import STATE_SCHEMA, continue_indicators
    rng = np.random.default_rng(8)
    d0 = dt.datetime(2024, 1, 1)
    rows = [("A", d0 + dt.timedelta(days=k), float(c)) for k, c in enumerate(50 + rng.normal(size=90).cumsum())]
    rows += [("B", d0 + dt.timedelta(days=k), float(c)) for k, c in enumerate(20 + rng.normal(size=30).cumsum())]
    schema = "ticker string, date timestamp, close double"
    want = {(r.ticker, r.date): r for r in with_indicators(spark.createDataFrame(rows, schema)).collect()}
    store = KeyedState(spark, str(tmp_path / "state"), STATE_SCHEMA, "ticker")
    got, edges = {}, [0, *cuts, 90]
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        part = [r for r in rows if a <= (r[1] - d0).days < b]
        sent = part + part[:1] + [r for r in rows if (r[1] - d0).days == a - 1] + [("A", d0 + dt.timedelta(days=b), None)]
        out, new, counts = continue_indicators(spark.createDataFrame(sent, schema), store.read(k), bounded)
        got.update({(r.ticker, r.date): r for r in out.collect()})
        assert {r.name: r.n for r in counts.collect()} == {"received": len(sent) - 1, "accepted": len(part)}
        store.write(k, new)
        assert store.read(k + 1).groupBy("ticker").count().filter("count > 19").count() == 0
    assert set(got) == set(want)
    for k, w in want.items():
        for c in ("sma_20", "ema_26", "macd_signal", "rsi_14", "bollinger_upper"):
            x, y = got[k][c], w[c]
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-8 * max(1, abs(y))), (k, c)


def test_end_to_end_writes_report(spark, tmp_path):
    from candela.plans import batch
    from candela.plans.end_to_end import run_all
    out = str(tmp_path / "e2e")
    flat = run_all(spark, bars(spark, SF_SMALL), out).first()
    assert flat.stream_batch_count >= 1 and flat.batch_total_time is not None
    doc = json.loads(open(glob.glob(out + "/results/*.json")[0]).read())
    assert set(doc) == {"streaming_performance", "batch_performance", "indicator_accuracy",
                        "signal_agreement"}
    # running the batch job again keeps one row per key and no duplicate signals
    batch.run(spark, spark.read.parquet(out + "/raw_stock_data"), out)
    ind = spark.read.parquet(out + "/technical_indicators")
    assert ind.count() == ind.select("date", "ticker", "processing_type").distinct().count()
    sig = spark.read.parquet(out + "/trading_signals")
    assert sig.count() == sig.select("date", "ticker", "processing_type", "signal_source").distinct().count()
