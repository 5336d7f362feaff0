"""Continuous indicators: a micro-batch continues each ticker's series.

The state of a ticker is its last 19 rows, the last of them with the values of
all recursive averages (20 numbers and 19 closes). New rows follow these as
history in the same scan, with the averages seeded, so results equal one run
over everything, however the rows are divided. Bars are unique by ticker and
day, so a ticker's rows of a batch are bounded by the calendar and one plan does
all (``series.bounded_scan``); bars of finer periods take the distributed scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions import series as S
from candela.functions.indicators import AVERAGES, scan_indicators
from candela.schemas import INDICATOR_COLUMNS
from candela.session import materialize, observed
from candela.sources.arrival import ARRIVAL

HISTORY = 19
SEEDS = {s.name: f"_seed_{s.name}" for s in AVERAGES}
STATE_COLUMNS = ["ticker", "date", "close", *SEEDS.values()]
STATE_SCHEMA = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("date", T.TimestampType()),
                             *[T.StructField(c, T.DoubleType()) for c in ["close", *SEEDS.values()]]])


def continue_indicators(bars: DataFrame, state: DataFrame | None,
                        bounded: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(indicator rows, state of the tickers with news, counts) of new ``bars`` (date, ticker, close).

    Rows without a date or close take no part. A row that is not newer than its
    ticker's last date is a repeat or late: it is dropped and counted. Of several
    rows of one (ticker, date) the last to arrive counts (of rows without an
    arrival the least close). The result is computed and stored once.
    """
    valued = bars.filter("date IS NOT NULL AND close IS NOT NULL").withColumn("close", F.col("close").cast("double"))
    close = F.max_by("close", ARRIVAL) if ARRIVAL in bars.columns else F.min("close")
    one = valued.groupBy("ticker", "date").agg(close.alias("close"), F.count(F.lit(1)).alias("_received"))
    got, accepted = Observation(), Observation()
    one = one.observe(got, F.sum("_received").alias("n"))
    none = [F.lit(None).cast("double").alias(c) for c in SEEDS.values()]
    rows = one.select("ticker", "date", "close", *none, F.lit(False).alias("_history"))
    if state is not None:
        rows = rows.unionByName(state.select(*STATE_COLUMNS, F.lit(True).alias("_history")))
        of_ticker = Window.partitionBy("ticker")
        rows = (rows.withColumn("_before", F.max(F.when(F.col("_history"), F.col("date"))).over(of_ticker))
                .filter("_history OR _before IS NULL OR date > _before").drop("_before")
                .withColumn("_news", F.max(~F.col("_history")).over(of_ticker)).filter("_news").drop("_news"))
    rows = rows.observe(accepted, F.count_if(~F.col("_history")).alias("n"))
    if bounded:
        done = scan_indicators(rows, by=("ticker",), seeds=SEEDS, history="_history", bounded=True)
        last = F.count(F.lit(1)).over(Window.partitionBy("ticker")) - 1
        done = materialize(done.withColumn("_from_end", last - F.col(S.POS)))
    else:
        done = materialize(scan_indicators(S.with_position(materialize(rows), "ticker", "date"), by=("ticker",),
                                           seeds=SEEDS, history="_history"))
        ends = done.groupBy("ticker").agg(F.max(S.POS).alias("_end"))
        done = S.null_safe_join(done, ends, ["ticker"]).withColumn("_from_end", F.col("_end") - F.col(S.POS))
    out = done.filter("NOT _history").select("date", "ticker", "close", *INDICATOR_COLUMNS)
    seeds = [F.when(F.col("_from_end") == 0, F.col(name)).alias(seed) for name, seed in SEEDS.items()]
    new_state = done.filter(F.col("_from_end") < HISTORY).select("ticker", "date", "close", *seeds)
    counts = bars.sparkSession.createDataFrame(
        [("received", int(observed(got).get("n") or 0)), ("accepted", int(observed(accepted).get("n") or 0))], "name string, n long")
    return out, new_state, counts
