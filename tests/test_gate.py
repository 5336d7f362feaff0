"""The bar gate: numbers that are none, repeated bars, headings in any order."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from candela.operators.quality import quarantine
from candela.plans import batch, stream_job
from candela.sources import arrival, files

BAR = "date date, ticker string, open double, high double, low double, close double, adj_close double, volume long"
NAN, INF = float("nan"), float("inf")


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def bar(k, close, ticker="T", high=1e6):
    return (day(k), ticker, close, high, -1e6, close, close, 1)


def walk(n):
    return [bar(k, 100.0 + (k * 13) % 17) for k in range(n)]


def indicators(spark, rows, out):
    batch.run(spark, spark.createDataFrame(rows, BAR), out)
    return {(r.date, r.ticker): r.asDict() for r in spark.read.parquet(out + "/technical_indicators").drop("created_at").collect()}


@pytest.mark.parametrize("bad", [NAN, INF, -INF])
def test_a_close_that_is_no_number_does_not_reach_later_rows(spark, tmp_path, bad):
    rows = walk(120)
    want = indicators(spark, rows[:30] + rows[31:], str(tmp_path / "a"))
    got = indicators(spark, rows[:30] + [bar(30, bad)] + rows[31:], str(tmp_path / "b"))
    assert got == want and len(got) == 100
    rejected = spark.read.parquet(str(tmp_path / "b") + "/rejected_bars").collect()
    assert [r.reason for r in rejected] == ["not_finite:open"]


def test_repeated_bars_do_not_shift_windows(spark, tmp_path):
    rows = walk(60)
    want = indicators(spark, rows, str(tmp_path / "a"))
    # stored in one file, so the first of a day is the first in it
    twice = rows + [bar(k, 1.0 + k) for k in (5, 6, 40)] + [rows[8]] + [rows[9]] * 3
    path = str(tmp_path / "staged")
    spark.createDataFrame(twice, BAR).coalesce(1).write.parquet(path)
    out = str(tmp_path / "b")
    batch.run(spark, arrival.of_files(spark.read.parquet(path)), out)
    got = {(r.date, r.ticker): r.asDict() for r in spark.read.parquet(out + "/technical_indicators").drop("created_at").collect()}
    assert got == want
    rejected = spark.read.parquet(out + "/rejected_bars")
    assert rejected.count() == 7 and {r.reason for r in rejected.collect()} == {"unique:date,ticker"}
    metric = spark.read.parquet(out + "/performance_metrics").first()
    assert json.loads(metric.details)["rejected_count"] == 7


def test_a_bad_bar_does_not_take_the_place_of_a_good_one(spark):
    rows = [bar(0, NAN), bar(0, 5.0), bar(0, 6.0), (day(0), None, 1.0, 1.0, 1.0, 1.0, 1.0, 1), (day(0), None, 1.0, 1.0, 1.0, 1.0, 1.0, 1)]
    valid, rejected = quarantine(spark.createDataFrame(rows, BAR).coalesce(1))
    assert [r.close for r in valid.collect()] == [5.0]
    assert sorted(r.reason for r in rejected.collect()) == ["not_finite:open", "not_null:ticker", "not_null:ticker", "unique:date,ticker"]


def test_one_key_may_hold_most_rows(spark):
    many = spark.range(20_000).select(F.lit(day(0)).alias("date"), F.lit("hot").alias("ticker"),
                                      *[(F.col("id") % 7 + 1).cast("double").alias(c) for c in ("open", "high")],
                                      F.lit(0.5).alias("low"), F.lit(1.0).alias("close"), F.lit(1.0).alias("adj_close"),
                                      F.col("id").alias("volume"))
    valid, rejected = quarantine(many)
    assert [r.volume for r in valid.collect()] == [0] and rejected.count() == 19_999


def test_no_bars(spark, tmp_path):
    valid, rejected = quarantine(spark.createDataFrame([], BAR))
    assert valid.count() == rejected.count() == 0
    metric = batch.run(spark, spark.createDataFrame([], BAR), str(tmp_path)).first()
    details = json.loads(metric.details)
    assert (details["record_count"], details["rejected_count"]) == (0, 0)


@pytest.mark.parametrize("text", ["NaN", '"NaN"', "Infinity", '"-Infinity"'])
def test_messages_with_no_number(spark, text):
    body = '{"date":"2024-01-02","ticker":"T","open":1.0,"high":2.0,"low":0.5,"close":%s,"adj_close":1.0,"volume":3}' % text
    df = spark.createDataFrame([(body,)], "value string")
    assert stream_job.valid_bars(df).count() == 0
    assert [r.reason for r in stream_job.rejected_messages(df).collect()] == ["not_finite:close"]


HEADING = "Date,Open,High,Low,Close,Adj Close,Volume"


def write(folder, name, heading, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([heading, *lines]) + "\n")


def test_csv_columns_are_bound_by_each_heading(spark, tmp_path):
    write(tmp_path / "ticker=A B", "1.csv", HEADING, "2024-01-02,1,9,0,2,3,10")
    write(tmp_path / "ticker=A B", "2.csv", "Volume,Close,Note,Date,High,Low,Open,Adj Close", '11,2.5,"a,b",2024-01-03,9,0,1.5,3.5')
    write(tmp_path / "ticker=C", "1.csv", '"Date","Open","High","Low","Close","Adj Close","Volume"', "2024-01-02,4,9,0,5,6,12")
    got = sorted(tuple(r) for r in files.read_csv_bars(spark, str(tmp_path)).collect())
    assert got == [(dt.date(2024, 1, 2), "A B", 1.0, 9.0, 0.0, 2.0, 3.0, 10), (dt.date(2024, 1, 2), "C", 4.0, 9.0, 0.0, 5.0, 6.0, 12),
                   (dt.date(2024, 1, 3), "A B", 1.5, 9.0, 0.0, 2.5, 3.5, 11)]
    single = files.read_csv_bars(spark, str(tmp_path / "ticker=A B" / "2.csv"), "X").first()
    assert (single.ticker, single.open, single.close) == ("X", 1.5, 2.5)


@pytest.mark.parametrize("heading", ["Date,Open,High,Low,Close,Volume", "Date,Open,High,Low,Close,Close,Adj Close,Volume", ""])
def test_a_heading_that_lacks_a_column_fails(spark, tmp_path, heading):
    write(tmp_path / "ticker=A", "1.csv", HEADING, "2024-01-02,1,9,0,2,3,10")
    write(tmp_path / "ticker=B", "wrong.csv", heading, "2024-01-02,1,9,0,2,10")
    with pytest.raises(ValueError, match="wrong.csv"):
        files.read_csv_bars(spark, str(tmp_path))


def test_no_csv_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("nothing")
    with pytest.raises(ValueError, match="no CSV file"):
        files.read_csv_bars(spark, str(tmp_path))
