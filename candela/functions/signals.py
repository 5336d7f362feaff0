"""Signal rules: one indicator row -> one to three signal rows.

The three rules are level tests (not crossings) and are evaluated in the order
SMA, RSI, MACD; a rule whose comparison is equal emits nothing; when no rule
emits, one HOLD row is produced. Built as an array of nullable structs and
exploded, so it stays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signal vocabulary, strengths, limits and texts.
BUY, SELL, HOLD = "BUY", "SELL", "HOLD"
SMA_CROSS, RSI, MACD, COMBINED = "SMA_CROSS", "RSI", "MACD", "COMBINED"
SMA_STRENGTH = 80.0
RSI_BASE_STRENGTH = 70.0
MACD_STRENGTH = 75.0
HOLD_STRENGTH = 50.0
RSI_OVERSOLD = 30.0
RSI_OVERBOUGHT = 70.0
TEXT_GOLDEN_CROSS = "Golden Cross: Short-term SMA crossed above long-term SMA"
TEXT_DEATH_CROSS = "Death Cross: Short-term SMA crossed below long-term SMA"
TEXT_OVERSOLD = "Oversold condition: RSI = %.2f"
TEXT_OVERBOUGHT = "Overbought condition: RSI = %.2f"
TEXT_MACD_ABOVE = "MACD line crossed above signal line"
TEXT_MACD_BELOW = "MACD line crossed below signal line"
TEXT_HOLD = "No clear buy or sell signals"

SIGNAL_INPUTS = ["sma_5", "sma_20", "rsi_14", "macd", "macd_signal"]


def _signal(kind: str, strength: Column | float, source: str, text: Column | str) -> Column:
    return F.struct(
        F.lit(kind).alias("signal_type"),
        (strength if isinstance(strength, Column) else F.lit(float(strength))).alias("signal_strength"),
        F.lit(source).alias("signal_source"),
        (text if isinstance(text, Column) else F.lit(text)).alias("description"),
    )


def signal_array(sma_short: Column, sma_long: Column, rsi: Column,
                 macd: Column, macd_signal: Column) -> Column:
    """array<struct<signal_type, signal_strength, signal_source, description>>."""
    by_sma = (F.when(sma_short > sma_long, _signal(BUY, SMA_STRENGTH, SMA_CROSS, TEXT_GOLDEN_CROSS))
               .when(sma_short < sma_long, _signal(SELL, SMA_STRENGTH, SMA_CROSS, TEXT_DEATH_CROSS)))
    by_rsi = (F.when(rsi < RSI_OVERSOLD,
                     _signal(BUY, F.lit(RSI_BASE_STRENGTH) + (F.lit(RSI_OVERSOLD) - rsi), RSI,
                             F.format_string(TEXT_OVERSOLD, rsi)))
               .when(rsi > RSI_OVERBOUGHT,
                     _signal(SELL, F.lit(RSI_BASE_STRENGTH) + (rsi - F.lit(RSI_OVERBOUGHT)), RSI,
                             F.format_string(TEXT_OVERBOUGHT, rsi))))
    by_macd = (F.when(macd > macd_signal, _signal(BUY, MACD_STRENGTH, MACD, TEXT_MACD_ABOVE))
                .when(macd < macd_signal, _signal(SELL, MACD_STRENGTH, MACD, TEXT_MACD_BELOW)))
    fired = F.filter(F.array(by_sma, by_rsi, by_macd), lambda s: s.isNotNull())
    return F.when(F.size(fired) == 0, F.array(_signal(HOLD, HOLD_STRENGTH, COMBINED, TEXT_HOLD))) \
            .otherwise(fired)


def signals(indicators: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Long signal table: one row per emitted signal.

    ``keep`` are the columns carried from the indicator row (default date,
    ticker and processing_type when present). ``signal_rank`` is the position
    of the signal in rule order (0-based).
    """
    if keep is None:
        keep = [c for c in ("date", "ticker", "processing_type") if c in indicators.columns]
    guarded = indicators.na.drop("any", subset=SIGNAL_INPUTS)
    arr = signal_array(F.col("sma_5"), F.col("sma_20"), F.col("rsi_14"),
                       F.col("macd"), F.col("macd_signal"))
    return (guarded.select(*keep, F.posexplode(arr).alias("signal_rank", "_s"))
                   .select(*keep, "signal_rank", "_s.*"))
