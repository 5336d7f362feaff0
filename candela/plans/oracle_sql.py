"""DuckDB SQL that computes the same results independently (the oracle).

The recursive averages are computed row by row with ``WITH RECURSIVE`` over
row numbers, the literal recursion ``y = q * y_prev + a * x``; rolling frames
with ``ROWS BETWEEN`` windows. The tables ``orders``, ``events`` … are views
registered by the caller.
"""

from __future__ import annotations

from candela.functions.series import span_alpha


def _d(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


A12, A26, A9, A14 = span_alpha(12), span_alpha(26), span_alpha(9), 1.0 / 14

BARS = """
bars AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS ticker,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         arg_max(o_totalprice, o_orderkey) AS adj_close, count(*) AS volume
  FROM orders GROUP BY 1, 2
)"""


def bars_where(name: str, where: str) -> str:
    """Daily bars over a filtered ``orders``."""
    return f"""
{name} AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS ticker,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         arg_max(o_totalprice, o_orderkey) AS adj_close, count(*) AS volume
  FROM orders WHERE {where} GROUP BY 1, 2
)"""


def indicators(src: str = "bars", out: str = "ind", part: tuple[str, ...] = ("ticker",),
               tag: str = "") -> str:
    """CTEs ``{out}_seq``, ``{out}_rec`` and ``{out}``: the wide indicator row per bar.

    ``part`` is the series key; every column of ``src`` is kept in ``{out}``.
    """
    p = ", ".join(part)
    ps = ", ".join(f"s.{c}" for c in part)
    on = " AND ".join(f"s.{c} = r.{c}" for c in part)
    e12 = f"({_d(1 - A12)} * r.ema_12 + {_d(A12)} * s.close)"
    e26 = f"({_d(1 - A26)} * r.ema_26 + {_d(A26)} * s.close)"
    q14, a14 = _d(1 - A14), _d(A14)
    frame = lambda n: f"(PARTITION BY {ps} ORDER BY s.date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""
{out}_seq AS (
  SELECT *, row_number() OVER (PARTITION BY {p} ORDER BY date) - 1 AS rn,
         close - lag(close) OVER (PARTITION BY {p} ORDER BY date) AS delta
  FROM {src}
),
{out}_rec AS (
  SELECT {p}, rn, close AS ema_12, close AS ema_26, CAST(0 AS DOUBLE) AS macd_signal,
         CAST(NULL AS DOUBLE) AS avg_up, CAST(NULL AS DOUBLE) AS avg_down
  FROM {out}_seq WHERE rn = 0
  UNION ALL
  SELECT {ps}, s.rn, {e12}, {e26},
         {_d(1 - A9)} * r.macd_signal + {_d(A9)} * ({e12} - {e26}),
         CASE WHEN s.rn = 1 THEN greatest(s.delta, 0) ELSE {q14} * r.avg_up + {a14} * greatest(s.delta, 0) END,
         CASE WHEN s.rn = 1 THEN greatest(-s.delta, 0) ELSE {q14} * r.avg_down + {a14} * greatest(-s.delta, 0) END
  FROM {out}_rec r JOIN {out}_seq s ON {on} AND s.rn = r.rn + 1
),
{out} AS (
  SELECT s.* EXCLUDE (rn, delta),
    CASE WHEN count(s.close) OVER {frame(5)} = 5 THEN avg(s.close) OVER {frame(5)} END AS sma_5,
    CASE WHEN count(s.close) OVER {frame(10)} = 10 THEN avg(s.close) OVER {frame(10)} END AS sma_10,
    CASE WHEN count(s.close) OVER {frame(20)} = 20 THEN avg(s.close) OVER {frame(20)} END AS sma_20,
    r.ema_12, r.ema_26, r.ema_12 - r.ema_26 AS macd, r.macd_signal,
    (r.ema_12 - r.ema_26) - r.macd_signal AS macd_histogram,
    CASE WHEN r.avg_down = 0 THEN CASE WHEN r.avg_up > 0 THEN CAST(100 AS DOUBLE) END
         ELSE 100 - 100 / (1 + r.avg_up / r.avg_down) END AS rsi_14,
    CASE WHEN count(s.close) OVER {frame(20)} = 20
         THEN avg(s.close) OVER {frame(20)} + stddev_samp(s.close) OVER {frame(20)} * 2 END AS bollinger_upper,
    CASE WHEN count(s.close) OVER {frame(20)} = 20 THEN avg(s.close) OVER {frame(20)} END AS bollinger_middle,
    CASE WHEN count(s.close) OVER {frame(20)} = 20
         THEN avg(s.close) OVER {frame(20)} - stddev_samp(s.close) OVER {frame(20)} * 2 END AS bollinger_lower,
    CASE WHEN count(s.close) OVER {frame(20)} = 20 THEN stddev_samp(s.close) OVER {frame(20)} END AS std_20,
    r.avg_up AS avg_gain, r.avg_down AS avg_loss, s.delta AS delta{tag}
  FROM {out}_seq s JOIN {out}_rec r ON {on} AND s.rn = r.rn
)"""
