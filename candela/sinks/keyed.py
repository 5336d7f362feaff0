"""Set-based table writes keyed by business keys.

* ``insert_if_absent``  staged rows are added only for keys the target lacks
                        (first staged row per key wins) — ``ON CONFLICT DO NOTHING``
* ``merge_latest``      keyed upsert, the newest version of a key wins —
                        ``ON CONFLICT DO UPDATE``
* ``replace_keys``      all rows of the touched keys are replaced by the new
                        ones: what a corrected input no longer gives, goes
* ``*_parquet``         the same on a Parquet table; a first load runs the same
                        code against an empty table. Tables that change by key
                        are partitioned by ``processing_type`` and month. The
                        touched months (a list that the calendar bounds) are
                        known before the table is read, so only their folders
                        are listed, read and rewritten, in one job.

NULL equals NULL in keys, so a row with a NULL key is stored once like any
other. All are joins and aggregations; groups are bounded by the number of
versions of one key, never by the size of a ticker.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.series import null_safe_join
from candela.schemas import PRICE_DECIMAL, STRENGTH_DECIMAL
from candela.session import delete_path, list_names, materialize, path_exists
from candela.sources.arrival import ARRIVAL, ensured

MONTH = "month"
CREATED = "created_at"
PARTITIONS = ["processing_type", MONTH]


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns (so the winner is defined)."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    rank = F.struct(*[F.col(c) for c in [*(order or ()), *(c for c in rest if c not in (order or ()))]])
    return (df.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
            .select(*key, "_row.*").select(*df.columns))


def new_rows(target: DataFrame, stage: DataFrame, key: Sequence[str],
             stage_order: Sequence[str] | None = None) -> DataFrame:
    """Staged rows whose key the target lacks (first staged row per key)."""
    fresh = null_safe_join(stage, target.select(*key).distinct(), key, "left_anti")
    return first_per_key(fresh, key, stage_order).select(*target.columns)


def insert_if_absent(target: DataFrame, stage: DataFrame, key: Sequence[str],
                     stage_order: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``target`` plus staged rows whose key is new.

    Within the stage the first row per key (by ``stage_order``) wins, like
    a bulk insert that skips conflicting rows.
    """
    return target.unionByName(new_rows(target, stage, key, stage_order))


def merge_latest(existing: DataFrame, updates: DataFrame, key: Sequence[str],
                 version: str | None = None) -> DataFrame:
    """Keyed upsert: per key the row with the highest version wins.

    Without ``version`` every row of ``updates`` is newer than ``existing``;
    of several updates with one key the greatest row wins. A ``max_by``
    aggregation per key (partial aggregation on both sides, at most one row per
    key and version in a group).
    """
    cols = [c for c in existing.columns if c not in key and c != version]
    old = existing.withColumn("_update", F.lit(0))
    both = old.unionByName(updates.select(*existing.columns).withColumn("_update", F.lit(1)))
    rank = F.struct(*([F.col(version)] if version else []), F.col("_update"), *[F.col(c) for c in cols])
    row = F.struct(*cols, *([version] if version else []))
    return (both.groupBy(*key).agg(F.max_by(row, rank).alias("_row"))
            .select(*key, "_row.*").select(*existing.columns))


def replace_keys(existing: DataFrame, rows: DataFrame, touched: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` without the rows of the ``touched`` keys, plus ``rows`` (repeated ones once)."""
    kept = null_safe_join(existing, touched.select(*key).distinct(), key, "left_anti")
    return kept.unionByName(rows.select(*existing.columns).distinct())


def stored(df: DataFrame, created: bool = True) -> DataFrame:
    """Columns as they are kept: exact decimals, the month, and the time of writing."""
    def kept(f: T.StructField):
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            kind = STRENGTH_DECIMAL if f.name == "signal_strength" else PRICE_DECIMAL
            return F.col(f.name).cast(kind).alias(f.name)
        return F.col(f.name)
    out = df.select(*[kept(f) for f in df.schema.fields])
    if "date" in df.columns:
        out = out.withColumn(MONTH, F.date_format("date", "yyyy-MM"))
    return out.withColumn(CREATED, F.current_timestamp()) if created else out


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None where there is no such path. Any error of the read stays an error."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def months(rows: DataFrame) -> list[tuple]:
    """The partitions (processing type, month) that rows with a date belong to."""
    return [tuple(r) for r in rows.select("processing_type", F.date_format("date", "yyyy-MM").alias(MONTH)).distinct().collect()]


def _folder(path: str, part: tuple) -> str:
    return os.path.join(path, *[f"{name}={value}" for name, value in zip(PARTITIONS, part)])


def partitions(spark: SparkSession, path: str, schema: T.StructType, touched: Sequence[tuple]) -> DataFrame:
    """The rows of the ``touched`` partitions; no other folder of the table is listed or read."""
    plain = all(value is not None and re.fullmatch(r"[\w-]+", value) for part in touched for value in part)
    if plain:
        there = {(kind, name.partition("=")[2]) for kind in {p[0] for p in touched}
                 for name in list_names(spark, os.path.join(path, f"{PARTITIONS[0]}={kind}"))}
        folders = [_folder(path, p) for p in touched if p in there]
    else:
        folders = [path] if path_exists(spark, path) else []
    if not folders:
        return spark.createDataFrame([], schema)
    wanted = F.lit(False)
    for kind in {p[0] for p in touched}:
        mine = [p[1] for p in touched if p[0] == kind]
        month = F.col(MONTH).isin([m for m in mine if m is not None])
        wanted = wanted | (F.col("processing_type").eqNullSafe(F.lit(kind)) & (month | F.col(MONTH).isNull() if None in mine else month))
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).filter(wanted)


def _rewrite(spark: SparkSession, path: str, schema: T.StructType, touched: Sequence[tuple], change,
             may_empty: bool = False) -> None:
    """Replace the ``touched`` partitions by ``change(their rows)``.

    One job: a dynamic overwrite writes beside the table and moves the folders
    when all rows are written. Rows of a month go to one task, unless there are
    so many that adaptive execution divides them.
    """
    if not touched:
        return
    before = {part: list_names(spark, _folder(path, part)) for part in touched if may_empty and None not in part}
    merged = change(partitions(spark, path, schema, touched)).select(*schema.names)
    (merged.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS).parquet(path))
    for part, names in before.items():  # the overwrite leaves a partition that has lost all its rows as it was
        if names and list_names(spark, _folder(path, part)) == names:
            delete_path(spark, _folder(path, part))


def upsert_parquet(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str],
                   touched: Sequence[tuple] | None = None) -> None:
    """Keyed upsert of ``updates``, a stored table (``touched``: its :func:`months`, if they are known)."""
    rows = stored(updates)
    _rewrite(spark, path, rows.schema, months(updates) if touched is None else touched,
             lambda base: merge_latest(base, rows, key))


def replace_parquet(spark: SparkSession, path: str, rows: DataFrame, keys: DataFrame, key: Sequence[str],
                    touched: Sequence[tuple] | None = None) -> None:
    """Replace all rows of the ``keys`` (a stored table with their columns) by ``rows``."""
    rows = stored(rows)
    _rewrite(spark, path, rows.schema, months(keys) if touched is None else touched,
             lambda base: replace_keys(base, rows, keys, key), may_empty=True)


def insert_parquet(spark: SparkSession, path: str, stage: DataFrame, key: Sequence[str],
                   stage_order: Sequence[str] | None = None) -> None:
    """Append the staged rows whose key the table lacks; of several the first by ``stage_order``, else by arrival."""
    rows = materialize(stored(ensured(stage)).drop(MONTH))
    schema = T.StructType([f for f in rows.schema.fields if f.name != ARRIVAL])
    target = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    materialize(new_rows(target, rows, key, stage_order or [ARRIVAL])).write.mode("append").parquet(path)
