"""Hand vectors (FIXTURES §3) and a long multi-ticker series against pandas."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from candela.functions import indicators as I
from conftest import bars_df

D0 = dt.date(2020, 1, 1)


def series(spark, closes, ticker="T", start=D0):
    rows = [(ticker, start + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return bars_df(spark, rows)


def col(df, name):
    return [r[name] for r in df.orderBy("ticker", "date").collect()]


def close_to(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(b))


def test_sma_warm_up(spark):
    out = I.sma(series(spark, [1, 2, 3, 4, 5, 6]), (5,))
    assert col(out, "sma_5") == [None] * 4 + [3.0, 4.0]


def test_sample_std(spark):
    out = I.rolling_std(series(spark, [1.0, 2.0]), 2)
    got = col(out, "std_2")
    assert got[0] is None and close_to(got[1], 0.7071067811865476)


def test_ema_span_12(spark):
    got = col(I.ema(series(spark, [1.0, 2.0, 3.0]), (12,)), "ema_12")
    for g, e in zip(got, [1.0, 1.1538461538, 1.4378698225]):
        assert close_to(g, e, 1e-9)


def test_wilder_leading_null(spark):
    # Wilder average of the gains of 0,1,3,6: gains NULL,1,2,3 -> NULL, 1, 1.0714.., 1.2092..
    got = col(I.wilder_avg(series(spark, [0.0, 1.0, 3.0, 6.0]), 14), "avg_gain")
    assert got[0] is None
    for g, e in zip(got[1:], [1.0, 1.0714285714, 1.2091836735]):
        assert close_to(g, e, 1e-9)


def test_rsi_only_gains_and_flat(spark):
    assert col(I.rsi(series(spark, [1.0, 2.0, 3.0]), 14), "rsi_14") == [None, 100.0, 100.0]
    assert col(I.rsi(series(spark, [5.0] * 5), 14), "rsi_14") == [None] * 5


def test_two_tickers_interleaved_equal_each_alone(spark):
    a = [10.0 + math.sin(i / 3.0) for i in range(150)]
    b = [20.0 + math.cos(i / 5.0) for i in range(150)]
    both = series(spark, a, "A").unionByName(series(spark, b, "B"))
    wide = I.with_indicators(both).orderBy("ticker", "date").collect()
    alone = I.with_indicators(series(spark, a, "A")).orderBy("date").collect()
    got_a = [r for r in wide if r["ticker"] == "A"]
    for x, y in zip(got_a, alone):
        for c in ("ema_26", "macd_signal", "rsi_14", "bollinger_upper"):
            assert close_to(x[c], y[c], 1e-12)


def pandas_reference(closes: pd.Series) -> pd.DataFrame:
    d = pd.DataFrame({"close": closes})
    d["sma_5"] = closes.rolling(5).mean()
    d["sma_20"] = closes.rolling(20).mean()
    d["ema_12"] = closes.ewm(span=12, adjust=False).mean()
    d["ema_26"] = closes.ewm(span=26, adjust=False).mean()
    d["macd"] = d.ema_12 - d.ema_26
    d["macd_signal"] = d.macd.ewm(span=9, adjust=False).mean()
    delta = closes.diff()
    up = delta.clip(lower=0).ewm(com=13, adjust=False).mean()
    down = (-1 * delta.clip(upper=0)).ewm(com=13, adjust=False).mean()
    d["rsi_14"] = 100 - 100 / (1 + up / down)
    d["bollinger_upper"] = d.sma_20 + 2 * closes.rolling(20).std()
    return d


@pytest.mark.parametrize("lengths", [(1, 63, 64, 65, 700, 3000)])
def test_long_series_many_blocks_match_pandas(spark, lengths):
    rng = np.random.default_rng(7)
    rows, ref = [], {}
    for k, n in enumerate(lengths):
        closes = 100 + np.cumsum(rng.normal(0, 1, n))
        t = f"T{k}"
        rows += [(t, D0 + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
        ref[t] = pandas_reference(pd.Series(closes))
    rng.shuffle(rows)
    wide = I.with_indicators(bars_df(spark, rows)).orderBy("ticker", "date").collect()
    by_t = {}
    for r in wide:
        by_t.setdefault(r["ticker"], []).append(r)
    for t, exp in ref.items():
        got = by_t[t]
        assert len(got) == len(exp)
        for c in ("sma_5", "ema_12", "ema_26", "macd", "macd_signal", "rsi_14", "bollinger_upper"):
            for i, r in enumerate(got):
                e = exp[c].iloc[i]
                g = r[c]
                if pd.isna(e):
                    assert g is None, (t, c, i)
                else:
                    assert g is not None and abs(g - e) <= 1e-9 * max(1.0, abs(e)), (t, c, i, g, e)


def test_complete_drops_warm_up(spark):
    wide = I.with_indicators(series(spark, [float(i % 7 + 1) for i in range(40)]))
    done = I.complete(wide, ["sma_20", "rsi_14", "bollinger_lower"])
    assert done.count() == 40 - 19


def test_series_across_superblocks_match_pandas(spark):
    """12,000 rows: several superblocks, so halos and carries cross partitions."""
    rng = np.random.default_rng(11)
    n = 12000
    closes = 50 + np.cumsum(rng.normal(0, 0.5, n))
    rows = [("L", D0 + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    exp = pandas_reference(pd.Series(closes))
    df = bars_df(spark, rows)
    wide = I.with_indicators(df).orderBy("date").collect()
    single = I.macd(df).orderBy("date").collect()
    assert len(wide) == n
    for c in ("sma_20", "ema_12", "ema_26", "macd_signal", "rsi_14", "bollinger_upper"):
        for i in range(0, n, 7):
            e, g = exp[c].iloc[i], wide[i][c]
            if pd.isna(e):
                assert g is None
            else:
                assert abs(g - e) <= 1e-9 * max(1.0, abs(e)), (c, i, g, e)
    for i in range(0, n, 11):
        assert abs(single[i]["macd_signal"] - exp["macd_signal"].iloc[i]) <= 1e-9 * max(1.0, abs(exp["macd_signal"].iloc[i]))
