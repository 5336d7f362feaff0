"""Data contracts of the stored tables: NOT NULL columns, finite prices, unique keys.

Each check is one aggregate (``count_if`` for NULLs, a grouped count for
duplicate keys), returned as long rows ``(table_name, check_name, violations)``.
Rows that break the bar contract are split off with a reason (``quarantine``)
before indicators are computed, in the batch and in the stream job: a NaN would
stay in every running sum after it, and a second bar of a day would shift all
windows of its ticker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.session import materialize
from candela.sources.arrival import ARRIVAL, ensured

# The contracts.
BAR_NOT_NULL = ["date", "ticker", "open", "high", "low", "close", "adj_close", "volume"]
BAR_KEY = ["date", "ticker"]
BAR_FINITE = ["open", "high", "low", "close", "adj_close"]
INDICATOR_NOT_NULL = ["date", "ticker", "processing_type"]
INDICATOR_KEY = ["date", "ticker", "processing_type"]
SIGNAL_NOT_NULL = ["date", "ticker", "processing_type", "signal_type", "signal_source"]


def violations(df: DataFrame, table: str, not_null: Sequence[str],
               key: Sequence[str] | None = None) -> DataFrame:
    """Long table of violation counts for one table."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    pairs = ", ".join(f"'not_null:{c}', `{c}`" for c in not_null)
    out = nulls.selectExpr(f"stack({len(not_null)}, {pairs}) AS (check_name, violations)")
    if key:
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
                 .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0).cast("bigint"))
                      .alias("violations"))
                 .select(F.lit("unique:" + ",".join(key)).alias("check_name"), "violations"))
        out = out.unionByName(dup)
    return out.select(F.lit(table).alias("table_name"), "check_name",
                      F.col("violations").cast("bigint").alias("violations"))


def not_finite(column: str) -> Column:
    """NaN or infinite (NULL and numbers of exact types are neither)."""
    x = F.col(column).cast("double")
    return F.isnan(x) | (F.abs(x) == F.lit(float("inf")))


def rejection() -> Column:
    """Why a bar by itself breaks the contract (NULL: it doesn't)."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in BAR_NOT_NULL],
                      *[F.when(not_finite(c), F.lit(f"not_finite:{c}")) for c in BAR_FINITE],
                      F.when(F.col("low") > F.col("high"), F.lit("low_above_high")))


def quarantine(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a ``reason``) by the bar contract.

    Of several otherwise valid bars of one (date, ticker) the first to arrive is
    valid (``sources.arrival``; rows without an arrival count in their order); the
    others are rejected as ``unique:date,ticker``. The rows are stored once. Keys
    with several bars are found by an aggregation that combines in map tasks, and
    only those are joined back, so a key that repeats a million times is no group
    in one task.
    """
    staged = materialize(ensured(bars).withColumn("reason", rejection()))
    repeated = (staged.filter("reason IS NULL").groupBy(*BAR_KEY)
                .agg(F.min(ARRIVAL).alias("_first"), F.count(F.lit(1)).alias("_bars")).filter("_bars > 1")
                .select(*[F.col(c).alias(f"_of_{c}") for c in BAR_KEY], "_first"))
    same = [F.col(c) == F.col(f"_of_{c}") for c in BAR_KEY]
    later = F.when(F.col("_first").isNotNull() & (F.col(ARRIVAL) != F.col("_first")), F.lit("unique:" + ",".join(BAR_KEY)))
    judged = (staged.join(repeated, [F.col("reason").isNull(), *same], "left")
              .withColumn("reason", F.coalesce("reason", later)).drop("_first", *[f"_of_{c}" for c in BAR_KEY]))
    return (judged.filter("reason IS NULL").drop("reason", ARRIVAL), judged.filter("reason IS NOT NULL").drop(ARRIVAL))
