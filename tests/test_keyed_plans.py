"""Keyed tables: which partitions are read and written, arrival order, partitions that lose all rows."""

import datetime as dt
import os

from candela.session import path_exists
from candela.sinks import keyed
from candela.sources import arrival

KEY = ["date", "ticker", "processing_type"]
TABLE = "date date, ticker string, processing_type string, v double"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, TABLE)


def months(n, tickers=("A", "B")):
    return [(dt.date(2000 + k // 12, k % 12 + 1, d), t, "BATCH", float(k)) for k in range(n) for d in (1, 15) for t in tickers]


def test_only_touched_months_are_listed_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.upsert_parquet(spark, path, rows_of(spark, months(40)), KEY)
    update = keyed.stored(rows_of(spark, [(dt.date(2000, 3, 15), "A", "BATCH", 99.0), (dt.date(2003, 1, 1), "A", "BATCH", 98.0)]))
    touched = keyed.months(update)
    base = keyed.partitions(spark, path, update.schema, touched)
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "month" in plan.split("PartitionFilters: [")[1]
    assert {r.month for r in base.collect()} == {"2000-03", "2003-01"}
    assert len(base.inputFiles()) == 2
    keyed.upsert_parquet(spark, path, update.drop("month", "created_at"), KEY)
    got = {(r.date, r.ticker): float(r.v) for r in spark.read.parquet(path).collect()}
    assert len(got) == 160 and got[dt.date(2000, 3, 15), "A"] == 99.0 and got[dt.date(2003, 1, 1), "A"] == 98.0
    assert got[dt.date(2000, 3, 15), "B"] == 2.0


def test_one_file_for_each_month(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        keyed.upsert_parquet(spark, path, rows_of(spark, months(30)).repartition(7), KEY)
    for folder, _dirs, names in os.walk(path):
        if "month=" in folder:
            assert sum(n.endswith(".parquet") for n in names) == 1
    assert spark.read.parquet(path).count() == 120


def test_a_month_that_loses_all_rows_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = rows_of(spark, months(3))
    keyed.replace_parquet(spark, path, rows, rows, KEY)
    keyed.replace_parquet(spark, path, rows.limit(0), rows.filter("month(date) = 2"), KEY)
    assert {r.date.month for r in spark.read.parquet(path).collect()} == {1, 3}
    assert not path_exists(spark, path + "/processing_type=BATCH/month=2000-02")


def test_null_dates_and_odd_types_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(None, "A", "BATCH", 1.0), (dt.date(2000, 1, 1), "A", "od d/x", 2.0), (dt.date(2000, 1, 1), "A", None, 3.0)]
    for value in (0.0, 5.0):
        keyed.upsert_parquet(spark, path, rows_of(spark, [(*r[:3], r[3] + value) for r in first]), KEY)
    got = sorted((str(r.date), str(r.processing_type), float(r.v)) for r in spark.read.parquet(path).collect())
    assert got == [("2000-01-01", "None", 8.0), ("2000-01-01", "od d/x", 7.0), ("None", "BATCH", 6.0)]


def test_the_first_row_to_arrive_is_stored(spark, tmp_path):
    """In one file, over files of one load, and over loads; neither the least nor the greatest row."""
    schema = "d string, ticker string, v int"
    stage, path = str(tmp_path / "stage"), str(tmp_path / "t")
    loads = [[("d1", "T", 5), ("d1", "T", 1), ("d1", "T", 9), ("d2", "T", 7)], [("d2", "T", 1), ("d3", "T", 4), ("d3", "T", 3)]]
    for k, rows in enumerate(loads):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{stage}/load={k}")
    df = arrival.of_files(spark.read.parquet(stage)).drop("load")
    for _ in range(2):
        keyed.insert_parquet(spark, path, df, ["d", "ticker"])
        assert sorted(tuple(r)[:3] for r in spark.read.parquet(path).select("d", "ticker", "v").collect()) == [
            ("d1", "T", 5), ("d2", "T", 7), ("d3", "T", 4)]
    assert arrival.ARRIVAL not in spark.read.parquet(path).columns
