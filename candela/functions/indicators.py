"""Technical indicators as DataFrame -> DataFrame functions.

Semantics follow pandas as used for daily bars:

* SMA N      ``rolling(N).mean()``          NULL until N rows
* STD N      ``rolling(N).std()``            sample std, NULL until N rows
* delta      ``diff()``                      NULL on the first row
* EMA span   ``ewm(span, adjust=False)``     y0 = x0, alpha = 2/(span+1)
* Wilder N   ``ewm(com=N-1, adjust=False)``  alpha = 1/N, starts at the first non-NULL
* MACD       line = EMA12 - EMA26, signal = EMA9(line), histogram = line - signal
* RSI N      100 - 100/(1 + Wilder(up)/Wilder(down)); 100 when only gains,
             NULL when flat (0/0)
* Bollinger  SMA N +- k * STD N

Every function takes the series key ``by`` (default ticker), the order column
(default date) and the value column (default close), and returns the input
columns plus the indicator columns. Rows with a NULL value or date are outside
the contract (``quality.quarantine`` counts and keeps them) and are filtered
first. Numbering reads its input twice (chunk counts and rows), so give these
functions a stored table with the columns they need, not a long plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions import series as S
from candela.functions.series import Ewm, span_alpha

BY = ("ticker",)
ORDER = "date"
VALUE = "close"


def _positioned(df: DataFrame, by, order: str, value: str) -> tuple[DataFrame, bool]:
    if S.POS in df.columns:
        return df, False
    valued = df.filter(F.col(value).isNotNull() & F.col(order).isNotNull())
    return S.with_position(valued, by, order), True


def _finish(df: DataFrame, added: bool) -> DataFrame:
    return df.drop(S.POS) if added else df


def sma(df: DataFrame, windows: Sequence[int] = (5, 10, 20), *, by=BY, order=ORDER,
        value=VALUE, prefix: str = "sma_") -> DataFrame:
    p, added = _positioned(df, by, order, value)
    cols = {f"{prefix}{n}": S.rolling_mean(value, n) for n in windows}
    return _finish(S.rolling(p, by, cols, halo=max(windows) - 1), added)


def rolling_std(df: DataFrame, window: int = 20, *, by=BY, order=ORDER, value=VALUE,
                name: str | None = None) -> DataFrame:
    p, added = _positioned(df, by, order, value)
    cols = {name or f"std_{window}": S.rolling_std(value, window)}
    return _finish(S.rolling(p, by, cols, halo=window - 1), added)


def delta(df: DataFrame, *, by=BY, order=ORDER, value=VALUE, name: str = "delta") -> DataFrame:
    p, added = _positioned(df, by, order, value)
    out = S.rolling(p, by, {"_prev": S.lagged(value)}, halo=1)
    out = out.withColumn(name, F.col(value) - F.col("_prev")).drop("_prev")
    return _finish(out, added)


def ema(df: DataFrame, spans: Sequence[int] = (12, 26), *, by=BY, order=ORDER,
        value=VALUE, prefix: str = "ema_") -> DataFrame:
    p, added = _positioned(df, by, order, value)
    specs = [Ewm(f"{prefix}{s}", value, span_alpha(s)) for s in spans]
    return _finish(S.ewm(p, by, specs), added)


def _up_down(df: DataFrame, value: str) -> DataFrame:
    """Gains and losses of the first difference; NULL on the first row."""
    d = F.col(value) - F.col("_prev")
    return (df.withColumn("_up", F.when(d > 0, d).when(d.isNotNull(), F.lit(0.0)))
              .withColumn("_down", F.when(d < 0, -d).when(d.isNotNull(), F.lit(0.0))))


def wilder_avg(df: DataFrame, window: int = 14, *, by=BY, order=ORDER, value=VALUE,
               up_name: str = "avg_gain", down_name: str = "avg_loss") -> DataFrame:
    """Wilder averages of gains and losses (the two halves of RSI)."""
    p, added = _positioned(df, by, order, value)
    a = 1.0 / window
    out = S.scan(p, by, {"_prev": S.lagged(value)}, lookback=1, prepare=lambda x: _up_down(x, value),
                 specs=[Ewm(up_name, "_up", a, start=1), Ewm(down_name, "_down", a, start=1)])
    return _finish(out.drop("_prev", "_up", "_down"), added)


def rsi_from(avg_up: Column, avg_down: Column) -> Column:
    """RSI from the two Wilder averages, without dividing by zero."""
    return (F.when(avg_down == 0, F.when(avg_up > 0, F.lit(100.0)))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + avg_up / avg_down)))


def rsi(df: DataFrame, window: int = 14, *, by=BY, order=ORDER, value=VALUE,
        name: str | None = None) -> DataFrame:
    out = wilder_avg(df, window, by=by, order=order, value=value,
                     up_name="_avg_up", down_name="_avg_down")
    return (out.withColumn(name or f"rsi_{window}", rsi_from(F.col("_avg_up"), F.col("_avg_down")))
               .drop("_avg_up", "_avg_down"))


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, *, by=BY,
         order=ORDER, value=VALUE) -> DataFrame:
    p, added = _positioned(df, by, order, value)
    out = S.scan(p, by, specs=[
        Ewm("_fast", value, span_alpha(fast)), Ewm("_slow", value, span_alpha(slow)),
        Ewm("macd_signal", {"_fast": 1.0, "_slow": -1.0}, span_alpha(signal))])
    out = (out.withColumn("macd", F.col("_fast") - F.col("_slow"))
              .withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
              .drop("_fast", "_slow"))
    return _finish(out, added)


def bollinger(df: DataFrame, window: int = 20, num_std: float = 2.0, *, by=BY,
              order=ORDER, value=VALUE) -> DataFrame:
    p, added = _positioned(df, by, order, value)
    out = S.rolling(p, by, {"bollinger_middle": S.rolling_mean(value, window),
                            "_std": S.rolling_std(value, window)}, halo=window - 1)
    k = F.lit(float(num_std))
    out = (out.withColumn("bollinger_upper", F.col("bollinger_middle") + F.col("_std") * k)
              .withColumn("bollinger_lower", F.col("bollinger_middle") - F.col("_std") * k)
              .drop("_std"))
    return _finish(out, added)


#: The recursive averages of the wide row.
AVERAGES = (Ewm("ema_12", VALUE, span_alpha(12)), Ewm("ema_26", VALUE, span_alpha(26)),
            Ewm("_avg_up", "_up", 1.0 / 14, start=1), Ewm("_avg_down", "_down", 1.0 / 14, start=1),
            Ewm("macd_signal", {"ema_12": 1.0, "ema_26": -1.0}, span_alpha(9)))


def scan_indicators(rows: DataFrame, *, by=BY, order=ORDER, value=VALUE, seeds: dict[str, str] | None = None,
                    history: str | None = None, bounded: bool = False) -> DataFrame:
    """All twelve indicators and their recursion state (``_avg_up``, ``_avg_down``) of positioned rows.

    One shuffle by (ticker, superblock) and one sort: SMA 5/10/20, STD 20 and
    the previous value as rolling frames, then all averages as one recursion.
    ``seeds`` and ``history`` continue a series (see ``series.scan``). With
    ``bounded``, rows need no positions and series are bounded by the calendar
    (``series.bounded_scan``).
    """
    specs = [Ewm(s.name, value if s.value == VALUE else s.value, s.alpha, s.start) for s in AVERAGES]
    frames = {
        "sma_5": S.rolling_mean(value, 5),
        "sma_10": S.rolling_mean(value, 10),
        "sma_20": S.rolling_mean(value, 20),
        "_std_20": S.rolling_std(value, 20),
        "_prev": S.lagged(value),
    }
    more = {"prepare": lambda x: _up_down(x, value), "specs": specs, "seeds": seeds, "history": history}
    out = (S.bounded_scan(rows, by, order, frames, **more) if bounded else
           S.scan(rows, by, frames, lookback=19, **more))
    two = F.lit(2.0)
    return (out.withColumn("macd", F.col("ema_12") - F.col("ema_26"))
               .withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
               .withColumn("rsi_14", rsi_from(F.col("_avg_up"), F.col("_avg_down")))
               .withColumn("bollinger_upper", F.col("sma_20") + F.col("_std_20") * two)
               .withColumn("bollinger_middle", F.col("sma_20"))
               .withColumn("bollinger_lower", F.col("sma_20") - F.col("_std_20") * two)
               .drop("_std_20", "_prev", "_up", "_down"))


def with_indicators(df: DataFrame, *, by=BY, order=ORDER, value=VALUE, bounded: bool = False) -> DataFrame:
    """All twelve indicators in one pass (the wide indicator row)."""
    if bounded:
        valued = df.filter(F.col(value).isNotNull() & F.col(order).isNotNull())
        return scan_indicators(valued, by=by, order=order, value=value, bounded=True).drop(S.POS, "_avg_up", "_avg_down")
    p, _added = _positioned(df, by, order, value)
    return scan_indicators(p, by=by, value=value).drop(S.POS, "_avg_up", "_avg_down")


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every indicator is defined (pandas ``dropna()``)."""
    return df.na.drop("any", subset=list(columns))
