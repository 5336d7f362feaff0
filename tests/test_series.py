"""Exact recursion: flat stretches, deep carry levels, continued series, NULL keys."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from candela.functions import indicators as I
from candela.functions import series as S
from conftest import bars_df
from test_indicators import close_to, col, series

D0 = dt.date(1990, 1, 1)


def pandas_rsi(close):
    d = pd.Series(close).diff()
    up, down = d.clip(lower=0), (-d).clip(lower=0)
    a, b = (x.ewm(com=13, adjust=False).mean() for x in (up, down))
    return 100 - 100 / (1 + a / b)


def flat_series():
    rng = np.random.default_rng(3)
    return list(100 + rng.normal(size=40).cumsum()) + [101.0] * 960


def test_rsi_survives_a_flat_stretch(spark):
    close = flat_series()
    want = pandas_rsi(close)
    got = col(I.rsi(series(spark, close)), "rsi_14")
    assert got[0] is None and sum(x is None for x in got) == 1
    assert all(close_to(a, b) for a, b in zip(got[1:], want[1:]))


def test_complete_rows_survive_a_flat_stretch(spark):
    from candela.plans.batch import indicator_rows
    assert indicator_rows(series(spark, flat_series())).count() == 981


@pytest.mark.parametrize("block,fan", [(4, 3), (7, 2), (1, 4)])
def test_carries_over_several_levels(spark, monkeypatch, block, fan):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "FAN", fan)
    rng = np.random.default_rng(1)
    close = 50 + rng.normal(size=230).cumsum()
    out = I.with_indicators(series(spark, close))
    s = pd.Series(close)
    e12, e26 = (s.ewm(span=n, adjust=False).mean() for n in (12, 26))
    want = {"ema_12": e12, "ema_26": e26, "macd_signal": (e12 - e26).ewm(span=9, adjust=False).mean(),
            "rsi_14": pandas_rsi(close), "sma_20": s.rolling(20).mean()}
    for name, w in want.items():
        got = col(out, name)
        assert all(close_to(a, None if np.isnan(b) else b, 1e-8) for a, b in zip(got, w)), name


def test_block_sizes_keep_weights_finite():
    for alpha in (0.01, 0.5, 0.9, 0.999, 1.0):
        spec = S.Ewm("y", "x", alpha)
        assert spec.decay == 0 or spec.decay ** -S.block_size([spec]) < float("inf")


def test_alpha_one_and_equal_decays(spark):
    close = list(np.random.default_rng(2).normal(size=300))
    p = S.with_position(series(spark, close), "ticker", "date")
    out = S.scan(p, "ticker", specs=[S.Ewm("a", "close", 1.0), S.Ewm("b", "close", 0.2),
                                     S.Ewm("c", {"b": 1.0}, 0.2), S.Ewm("d", "close", 0.98)])
    b = pd.Series(close).ewm(alpha=0.2, adjust=False).mean()
    want = {"a": close, "b": b, "c": b.ewm(alpha=0.2, adjust=False).mean(),
            "d": pd.Series(close).ewm(alpha=0.98, adjust=False).mean()}
    for name, w in want.items():
        assert all(close_to(x, y, 1e-8) for x, y in zip(col(out, name), w)), name


def test_null_key_and_null_date(spark):
    rows = [(None, D0 + dt.timedelta(days=k), float(k)) for k in range(6)] + [("T", None, 1.0), ("T", D0, 2.0)]
    out = I.sma(bars_df(spark, rows), (5,)).collect()
    assert len(out) == 7  # a NULL ticker is a series; a row without a date has no place in one
    assert [r.sma_5 for r in sorted((r for r in out if r.ticker is None), key=lambda r: r.date)][4:] == [2.0, 3.0]


def test_hourly_bars_are_numbered(spark):
    rows = [("T", dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), float(k)) for k in range(3000)]
    df = spark.createDataFrame(rows, "ticker string, date timestamp, close double")
    got = S.with_position(df, "ticker", "date").filter("_pos != close").count()
    assert got == 0
