"""DuckDB SQL for every registered query that has a SQL equivalent.

Each text runs on the views ``orders``, ``events`` … and returns the same
columns (names and rounding) as the Spark query of the same name.
"""

from __future__ import annotations

from candela.plans import oracle_sql as O

R = 4
IND = ["sma_5", "sma_10", "sma_20", "ema_12", "ema_26", "macd", "macd_signal", "macd_histogram",
       "rsi_14", "bollinger_upper", "bollinger_middle", "bollinger_lower"]
TICKER = "1-URGENT"


def r(c: str, alias: str | None = None) -> str:
    return f"round({c}, {R}) AS {alias or c.split('.')[-1]}"


def rs(cols) -> str:
    return ", ".join(r(c) for c in cols)


def with_ind(*extra: str) -> str:
    return "WITH RECURSIVE " + ",".join([O.BARS, O.indicators(), *extra])


COMPLETE_WHERE = " AND ".join(f"{c} IS NOT NULL" for c in ["close", *IND])

# complete indicator rows of one source -> CTE {name}
def complete_cte(name: str, src: str, ptype: str) -> str:
    return f"""
{name} AS (
  SELECT date, ticker, CAST('{ptype}' AS VARCHAR) AS processing_type, close, {", ".join(IND)}
  FROM {src} WHERE {COMPLETE_WHERE}
)"""


def signals_cte(name: str, src: str) -> str:
    fired_sma = "(sma_5 <> sma_20)"
    fired_rsi = "(rsi_14 < 30 OR rsi_14 > 70)"
    fired_macd = "(macd <> macd_signal)"
    return f"""
{name} AS (
  SELECT date, ticker, processing_type, CAST(0 AS INTEGER) AS signal_rank,
         CASE WHEN sma_5 > sma_20 THEN 'BUY' ELSE 'SELL' END AS signal_type,
         CAST(80 AS DOUBLE) AS signal_strength, 'SMA_CROSS' AS signal_source,
         CASE WHEN sma_5 > sma_20 THEN 'Golden Cross: Short-term SMA crossed above long-term SMA'
              ELSE 'Death Cross: Short-term SMA crossed below long-term SMA' END AS description
  FROM {src} WHERE {fired_sma}
  UNION ALL
  SELECT date, ticker, processing_type, CAST({fired_sma} AS INTEGER),
         CASE WHEN rsi_14 < 30 THEN 'BUY' ELSE 'SELL' END,
         CASE WHEN rsi_14 < 30 THEN 70 + (30 - rsi_14) ELSE 70 + (rsi_14 - 70) END,
         'RSI',
         CASE WHEN rsi_14 < 30 THEN printf('Oversold condition: RSI = %.2f', rsi_14)
              ELSE printf('Overbought condition: RSI = %.2f', rsi_14) END
  FROM {src} WHERE {fired_rsi}
  UNION ALL
  SELECT date, ticker, processing_type, CAST({fired_sma} AS INTEGER) + CAST({fired_rsi} AS INTEGER),
         CASE WHEN macd > macd_signal THEN 'BUY' ELSE 'SELL' END, CAST(75 AS DOUBLE), 'MACD',
         CASE WHEN macd > macd_signal THEN 'MACD line crossed above signal line'
              ELSE 'MACD line crossed below signal line' END
  FROM {src} WHERE {fired_macd}
  UNION ALL
  SELECT date, ticker, processing_type, CAST(0 AS INTEGER), 'HOLD', CAST(50 AS DOUBLE), 'COMBINED',
         'No clear buy or sell signals'
  FROM {src} WHERE NOT {fired_sma} AND NOT {fired_rsi} AND NOT {fired_macd}
)"""


SIG_COLS = "date, ticker, processing_type, signal_rank, signal_type, " \
           f"{r('signal_strength')}, signal_source, description"

# Both processing types: batch rows and rows restarted per calendar year.
BOTH = ",".join([
    O.BARS, O.indicators(),
    "bars_y AS (SELECT *, year(date) AS _year FROM bars)",
    O.indicators("bars_y", "ind_y", ("ticker", "_year")),
    complete_cte("batch_ind", "ind", "BATCH"),
    complete_cte("stream_ind", "ind_y", "STREAMING"),
    signals_cte("batch_sig", "batch_ind"),
    signals_cte("stream_sig", "stream_ind"),
    "all_sig AS (SELECT * FROM batch_sig UNION ALL SELECT * FROM stream_sig)",
    """diffs AS (
  SELECT s.date, s.ticker, s.sma_20 AS stream_sma20, b.sma_20 AS batch_sma20,
         abs(s.sma_20 - b.sma_20) AS sma_diff, s.rsi_14 AS stream_rsi, b.rsi_14 AS batch_rsi,
         abs(s.rsi_14 - b.rsi_14) AS rsi_diff, s.macd AS stream_macd, b.macd AS batch_macd,
         abs(s.macd - b.macd) AS macd_diff
  FROM stream_ind s JOIN batch_ind b ON s.date = b.date AND s.ticker = b.ticker
)""",
    """counts AS (
  SELECT date,
    count(CASE WHEN processing_type = 'STREAMING' AND signal_type = 'BUY' THEN 1 END) AS stream_buy,
    count(CASE WHEN processing_type = 'BATCH' AND signal_type = 'BUY' THEN 1 END) AS batch_buy,
    count(CASE WHEN processing_type = 'STREAMING' AND signal_type = 'SELL' THEN 1 END) AS stream_sell,
    count(CASE WHEN processing_type = 'BATCH' AND signal_type = 'SELL' THEN 1 END) AS batch_sell,
    count(CASE WHEN processing_type = 'STREAMING' AND signal_type = 'HOLD' THEN 1 END) AS stream_hold,
    count(CASE WHEN processing_type = 'BATCH' AND signal_type = 'HOLD' THEN 1 END) AS batch_hold
  FROM all_sig GROUP BY date
)""",
    """accuracy AS (
  SELECT avg(sma_diff) AS avg_sma_diff, avg(rsi_diff) AS avg_rsi_diff, avg(macd_diff) AS avg_macd_diff
  FROM diffs
)""",
    """agreement AS (
  SELECT avg(CASE WHEN stream_buy = batch_buy THEN 1.0 ELSE 0.0 END) * 100 AS buy_agreement,
         avg(CASE WHEN stream_sell = batch_sell THEN 1.0 ELSE 0.0 END) * 100 AS sell_agreement,
         avg(CASE WHEN stream_hold = batch_hold THEN 1.0 ELSE 0.0 END) * 100 AS hold_agreement
  FROM counts
)""",
])

METRICS = """
metrics AS (
  SELECT ts AS execution_date,
         CASE WHEN event_id % 2 = 0 THEN 'BATCH' ELSE 'STREAMING' END AS processing_type,
         CASE WHEN event_type = 'error' THEN 'ERROR_TIME' ELSE 'PROCESSING_TIME' END AS metric_name,
         value * 10 AS metric_value,
         CAST(user_id AS VARCHAR) || ' records' AS window_size,
         '{"batch_id":' || CAST(event_id AS VARCHAR) || ',"record_count":' || CAST(user_id AS VARCHAR) || '}'
           AS details
  FROM events
),
times AS (
  SELECT * FROM metrics WHERE metric_name = 'PROCESSING_TIME'
),
summary AS (
  SELECT processing_type, avg(metric_value) AS avg_time, sum(metric_value) AS total_time,
         count(*) AS run_count
  FROM times GROUP BY processing_type
)"""

WINDOWED = """
win AS (
  SELECT *, DATE '1970-01-01' + CAST(floor((date - DATE '1970-01-01') / 20) * 20 AS INTEGER) AS window_start
  FROM bars
)"""

BAR_SELECT = "date, ticker, open, high, low, close, adj_close, volume"


def _dec(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(16,6)) AS VARCHAR)"


def _json(fields: list[tuple[str, str]]) -> str:
    parts = []
    for i, (name, expr) in enumerate(fields):
        parts.append(("'{" if i == 0 else "',") + f'"{name}":' + "' || " + expr)
    return " || ".join(parts) + " || '}'"


def _q(s: str) -> str:
    return "'\"' || " + s + " || '\"'"


BAR_JSON = _json([("date", _q("strftime(date, '%Y-%m-%d')")), ("ticker", _q("ticker")),
                  *[(c, _dec(c)) for c in ["open", "high", "low", "close", "adj_close"]],
                  ("volume", "CAST(volume AS VARCHAR)")])
IND_JSON = _json([("date", _q("strftime(date, '%Y-%m-%d')")), ("ticker", _q("ticker")),
                  *[(c, _dec(f"round({c}, 4)")) for c in IND]])
SIG_JSON = _json([("date", _q("strftime(date, '%Y-%m-%d')")), ("ticker", _q("ticker")),
                  ("signal_type", _q("signal_type")),
                  ("signal_strength", "CAST(CAST(signal_strength AS DECIMAL(5,2)) AS VARCHAR)"),
                  ("signal_source", _q("signal_source")), ("description", _q("description"))])

SETTLED = O.bars_where("settled", "o_orderstatus = 'F'")

ORACLES: dict[str, str] = {
    "sma": with_ind() + f" SELECT date, ticker, {rs(['close', 'sma_5', 'sma_10', 'sma_20'])} FROM ind",
    "rolling_std": with_ind() + f" SELECT date, ticker, {rs(['close', 'std_20'])} FROM ind",
    "price_delta": with_ind() + f" SELECT date, ticker, {rs(['close', 'delta'])} FROM ind",
    "ema": with_ind() + f" SELECT date, ticker, {rs(['close', 'ema_12', 'ema_26'])} FROM ind",
    "wilder_avg": with_ind() + f" SELECT date, ticker, {rs(['avg_gain', 'avg_loss'])} FROM ind",
    "macd": with_ind() + f" SELECT date, ticker, {rs(['macd', 'macd_signal', 'macd_histogram'])} FROM ind",
    "rsi": with_ind() + f" SELECT date, ticker, {rs(['rsi_14'])} FROM ind",
    "bollinger": with_ind() + " SELECT date, ticker, "
                 f"{rs(['bollinger_upper', 'bollinger_middle', 'bollinger_lower'])} FROM ind",
    "indicators_wide": with_ind() + f" SELECT date, ticker, {rs(['close', *IND])} FROM ind",
    "indicators_complete": with_ind(complete_cte("c", "ind", "BATCH"))
                           + f" SELECT date, ticker, processing_type, {rs(['close', *IND])} FROM c",
    "signals_long": with_ind(complete_cte("c", "ind", "BATCH"), signals_cte("sig", "c"))
                    + f" SELECT {SIG_COLS} FROM sig",
    "batch_project_filter_sort": f"WITH {O.BARS} SELECT {BAR_SELECT} FROM bars "
                                 f"WHERE ticker = '{TICKER}' ORDER BY date",
    "latest_indicators_limit": with_ind(complete_cte("c", "ind", "BATCH"))
                               + f" SELECT date, ticker, processing_type, {rs(['close', *IND])} FROM c "
                                 "ORDER BY date DESC, ticker LIMIT 10",
    "ingest_csv_bars": f"WITH {O.BARS} SELECT {BAR_SELECT} FROM bars",
    "scan_jdbc": f"WITH {O.BARS} SELECT {BAR_SELECT} FROM bars",
    "insert_if_absent": f"WITH {O.BARS}, {SETTLED} SELECT {BAR_SELECT} FROM settled UNION ALL "
                        f"SELECT {BAR_SELECT} FROM bars b WHERE NOT EXISTS "
                        "(SELECT 1 FROM settled s WHERE s.date = b.date AND s.ticker = b.ticker)",
    "upsert_indicators": "WITH RECURSIVE " + ",".join([
        O.BARS, O.indicators(), SETTLED, O.indicators("settled", "ind_s"),
        complete_cte("ex", "ind", "BATCH"), complete_cte("up", "ind_s", "BATCH")])
        + f" SELECT date, ticker, processing_type, {rs(['close', *IND])} FROM up UNION ALL "
          f"SELECT date, ticker, processing_type, {rs(['close', *IND])} FROM ex e WHERE NOT EXISTS "
          "(SELECT 1 FROM up u WHERE u.date = e.date AND u.ticker = e.ticker "
          "AND u.processing_type = e.processing_type)",
    "append_signals_dedup": "WITH RECURSIVE " + ",".join([
        BOTH, SETTLED, O.indicators("settled", "ind_s"), complete_cte("first_ind", "ind_s", "BATCH"),
        signals_cte("first_sig", "first_ind")])
        + f" SELECT {SIG_COLS} FROM all_sig UNION ALL SELECT {SIG_COLS} FROM first_sig f WHERE NOT EXISTS "
          "(SELECT 1 FROM batch_ind b WHERE b.date = f.date AND b.ticker = f.ticker)",
    "publish_bar_json": f"WITH {O.BARS} SELECT ticker AS key, {BAR_JSON} AS value FROM bars",
    "publish_indicator_json": with_ind(complete_cte("c", "ind", "BATCH"))
                              + f" SELECT ticker AS key, {IND_JSON} AS value FROM c",
    "publish_signal_json": with_ind(complete_cte("c", "ind", "BATCH"), signals_cte("sig", "c"))
                           + f" SELECT ticker AS key, {SIG_JSON} AS value FROM sig",
    "json_roundtrip": f"WITH {O.BARS} SELECT {BAR_SELECT} FROM bars",
    "window_bucket": f"WITH {O.BARS}, {WINDOWED} SELECT date, ticker, window_start, "
                     "window_start + 20 AS window_end FROM win",
    "window_collect_flatten": f"WITH {O.BARS}, {WINDOWED} SELECT date, ticker, window_start, "
                              "window_start + 20 AS window_end, open, high, low, close, adj_close, "
                              "volume FROM win",
    "compare_indicators": "WITH RECURSIVE " + BOTH + " SELECT date, ticker, " + rs([
        "stream_sma20", "batch_sma20", "sma_diff", "stream_rsi", "batch_rsi", "rsi_diff",
        "stream_macd", "batch_macd", "macd_diff"]) + " FROM diffs",
    "indicator_accuracy": "WITH RECURSIVE " + BOTH + " SELECT "
                          + rs(["avg_sma_diff", "avg_rsi_diff", "avg_macd_diff"]) + " FROM accuracy",
    "signal_counts": "WITH RECURSIVE " + BOTH + " SELECT * FROM counts",
    "signal_agreement": "WITH RECURSIVE " + BOTH + " SELECT "
                        + rs(["buy_agreement", "sell_agreement", "hold_agreement"]) + " FROM agreement",
    "metrics_filtered": f"WITH {METRICS} SELECT execution_date, processing_type, metric_name, "
                        f"{r('metric_value')}, window_size, details FROM times WHERE metric_value < 3600 "
                        "ORDER BY execution_date, processing_type, details",
    "perf_summary": f"WITH {METRICS} SELECT processing_type, {rs(['avg_time', 'total_time'])}, "
                    "run_count FROM summary",
    "comparison_report": "WITH RECURSIVE " + BOTH + "," + METRICS + """
        SELECT round((SELECT avg_time FROM summary WHERE processing_type = 'STREAMING'), 4) AS stream_avg_time,
               round((SELECT total_time FROM summary WHERE processing_type = 'STREAMING'), 4) AS stream_total_time,
               coalesce((SELECT run_count FROM summary WHERE processing_type = 'STREAMING'), 0) AS stream_batch_count,
               round((SELECT total_time FROM summary WHERE processing_type = 'BATCH'), 4) AS batch_total_time,
               round(a.avg_sma_diff, 4) AS avg_sma_diff, round(a.avg_rsi_diff, 4) AS avg_rsi_diff,
               round(a.avg_macd_diff, 4) AS avg_macd_diff,
               round(g.buy_agreement, 4) AS buy_agreement, round(g.sell_agreement, 4) AS sell_agreement,
               round(g.hold_agreement, 4) AS hold_agreement
        FROM accuracy a, agreement g""",
}


def quality_sql() -> str:
    def nulls(table: str, src: str, cols: list[str]) -> list[str]:
        return [f"SELECT '{table}' AS table_name, 'not_null:{c}' AS check_name, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {src}" for c in cols]

    def dup(table: str, src: str, key: list[str]) -> str:
        k = ", ".join(key)
        return (f"SELECT '{table}', 'unique:{','.join(key)}', coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) "
                f"FROM (SELECT {k}, count(*) AS n FROM {src} GROUP BY {k})")
    bar_cols = ["date", "ticker", "open", "high", "low", "close", "adj_close", "volume"]
    hourly = """
hourly AS (
  SELECT date_trunc('hour', ts) AS date, event_type AS ticker, arg_min(value, ts) AS open,
         max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
         arg_max(value, ts) AS adj_close, count(*) AS volume
  FROM events GROUP BY 1, 2
)"""
    parts = (nulls("raw_stock_data", "bars", bar_cols) + [dup("raw_stock_data", "bars", ["date", "ticker"])]
             + nulls("hourly_bars", "hourly", bar_cols) + [dup("hourly_bars", "hourly", ["date", "ticker"])]
             + nulls("technical_indicators", "c", ["date", "ticker", "processing_type"])
             + [dup("technical_indicators", "c", ["date", "ticker", "processing_type"])]
             + nulls("trading_signals", "sig",
                     ["date", "ticker", "processing_type", "signal_type", "signal_source"]))
    return (with_ind(complete_cte("c", "ind", "BATCH"), signals_cte("sig", "c"), hourly)
            + " SELECT table_name, check_name, CAST(violations AS BIGINT) AS violations FROM ("
            + " UNION ALL ".join(parts) + ")")


ORACLES["quality_violations"] = quality_sql()


# Stream legs. Deliveries are periods of 2 calendar years; the micro-batch of
# a delivery holds every row of the windows it touches (delivered so far).
POOLS = ",".join([
    O.BARS,
    """win AS (
  SELECT *, DATE '1970-01-01' + CAST(floor((date - DATE '1970-01-01') / 20) * 20 AS INTEGER) AS window_start,
         floor(year(date) / 2) AS delivery
  FROM bars
)""",
    "touched AS (SELECT DISTINCT ticker, window_start, delivery AS pool FROM win)",
    """pooled AS (
  SELECT w.date, w.ticker, w.close, t.pool
  FROM win w JOIN touched t
    ON w.ticker = t.ticker AND w.window_start = t.window_start AND w.delivery <= t.pool
)""",
    O.indicators("pooled", "ind_p", ("ticker", "pool")),
    f"""latest AS (
  SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY pool DESC) AS rk
  FROM ind_p WHERE {COMPLETE_WHERE}
)""",
])

WINDOW_ROWS = (f"WITH {O.BARS}, {WINDOWED} SELECT date, ticker, window_start, "
               "window_start + 20 AS window_end, open, high, low, close, adj_close, volume FROM win")

ORACLES.update({
    "stream_json_ingest": f"WITH {O.BARS} SELECT {BAR_SELECT} FROM bars",
    "stream_dedup": f"WITH {O.BARS} SELECT {BAR_SELECT} FROM bars",
    "stream_window_collect": WINDOW_ROWS,
    "stream_late_rows": WINDOW_ROWS,
    "stream_window_indicators": "WITH RECURSIVE " + POOLS
        + " SELECT date, ticker, 'STREAMING' AS processing_type, "
        + ", ".join(f"CAST(round(CAST({c} AS DECIMAL(16,6)), 3) AS DOUBLE) AS {c}" for c in ["close", *IND])
        + " FROM latest WHERE rk = 1",
    "stream_indicators_stateful": with_ind(complete_cte("c", "ind", "STREAMING"))
        + f" SELECT date, ticker, processing_type, {rs(['close', *IND])} FROM c",
})

STORED_STRENGTH = "CAST(CAST(signal_strength AS DECIMAL(5,2)) AS DOUBLE) AS signal_strength"
MESSAGES = """
msg AS (
  SELECT b.*, (date - DATE '1970-01-01') % 11 AS kind FROM bars b
)"""

ORACLES.update({
    "stream_window_signals": "WITH RECURSIVE " + POOLS + ","
        + "stored AS (SELECT *, 'STREAMING' AS processing_type FROM latest WHERE rk = 1),"
        + signals_cte("sig", "stored")
        + f" SELECT date, ticker, processing_type, signal_rank, signal_type, {STORED_STRENGTH}, "
          "signal_source, description FROM sig",
    "stream_metrics": "WITH RECURSIVE " + POOLS + """
        SELECT 'STREAMING' AS processing_type, 'PROCESSING_TIME' AS metric_name,
               CAST(count(*) AS VARCHAR) || ' records' AS window_size, count(*) AS record_count, true AS timed
        FROM pooled GROUP BY pool""",
    "run_metrics": with_ind(complete_cte("c", "ind", "BATCH")) + """
        SELECT 'BATCH' AS processing_type, 'PROCESSING_TIME' AS metric_name, 'FULL DATASET' AS window_size,
               count(*) AS record_count, true AS timed FROM c""",
    "quarantine_bars": f"WITH {O.BARS}, {MESSAGES}" + """
        SELECT CASE kind WHEN 1 THEN 'not_null:close' WHEN 2 THEN 'not_null:ticker' WHEN 3 THEN 'low_above_high'
                         WHEN 4 THEN 'not_null:date' WHEN 5 THEN 'not_null:date' ELSE 'valid' END AS reason,
               count(*) AS rows
        FROM msg GROUP BY 1""",
})

KIND = "((date - DATE '1970-01-01') % 11)"
PRICES = ["open", "high", "low", "close", "adj_close"]


def priced(factor: str, columns: str = "date, ticker, {prices}, volume") -> str:
    return columns.format(prices=", ".join(f"{c} * {factor} AS {c}" for c in PRICES))


ORACLES.update({
    "latest_signals_limit": with_ind(complete_cte("c", "ind", "BATCH"), signals_cte("sig", "c"))
        + f" SELECT date, ticker, processing_type, signal_rank, signal_type, {r('signal_strength')}, signal_source, description "
          "FROM sig ORDER BY date DESC, ticker, signal_rank LIMIT 10",
    "metric_values": f"WITH {METRICS} SELECT processing_type, metric_name, {r('metric_value')} FROM metrics",
    "insert_first_arrival": f"WITH {O.BARS}, {SETTLED} SELECT date, ticker, {rs(PRICES)}, volume FROM settled UNION ALL "
        f"SELECT date, ticker, {', '.join(r(f'{c} * 2', c) for c in PRICES)}, volume FROM bars b WHERE NOT EXISTS "
        "(SELECT 1 FROM settled s WHERE s.date = b.date AND s.ticker = b.ticker)",
    "quarantine_conflicts": f"WITH {O.BARS}" + f"""
        SELECT CASE {KIND} WHEN 1 THEN 'not_finite:close' WHEN 2 THEN 'not_finite:high' ELSE 'unique:date,ticker' END AS reason,
               count(*) AS rows
        FROM bars WHERE {KIND} IN (1, 2, 3, 5, 7) GROUP BY 1
        UNION ALL SELECT 'valid', count(*) FROM bars WHERE {KIND} <> 2""",
    "gated_indicators": "WITH RECURSIVE " + ",".join([
        O.BARS, f"gated AS (SELECT * FROM bars WHERE {KIND} <> 2)", O.indicators("gated", "ind")])
        + " SELECT date, ticker, 'BATCH' AS processing_type, "
        + ", ".join(f"CAST(round(CAST({c} AS DECIMAL(16,6)), 3) AS DOUBLE) AS {c}" for c in ["close", *IND])
        + f" FROM ind WHERE {COMPLETE_WHERE}",
    "stream_corrections": f"WITH {O.BARS}, {WINDOWED} SELECT "
        + priced("CASE WHEN (date - DATE '1970-01-01') % 2 = 0 THEN 1.5 ELSE 0.5 END",
                 "date, ticker, window_start, window_start + 20 AS window_end, {prices}, volume") + " FROM win",
    "stream_batch_details": "WITH RECURSIVE " + POOLS + """,
        batches AS (SELECT pool, count(*) AS records FROM pooled GROUP BY 1)
        SELECT row_number() OVER (ORDER BY pool) AS batch, records AS record_count, records AS repeat_count,
               false AS late, true AS timed FROM batches
        UNION ALL SELECT (SELECT count(*) + 1 FROM batches), 0, 0, true, true""",
})
