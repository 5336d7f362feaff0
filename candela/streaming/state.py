"""State of a series by key, between micro-batches: a base and deltas, in buckets of keys.

A batch writes only the keys it touched (a delta). Reading takes, of the buckets
that the batch's keys fall into, the latest version of each key before the batch;
a batch that is run again therefore reads what it read the first time. Every
``compact_every`` deltas the versions before the newest batch become one base
and their files go, so files and old versions don't pile up.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.series import null_safe_join
from candela.session import delete_path, list_names

BUCKET = "bucket"
VERSION = "version"


class KeyedState:
    """``rows`` of several per key (``key``); the rows of a key are replaced together."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64,
                 compact_every: int = 16):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.buckets, self.compact_every = buckets, compact_every

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[tuple[int, str]]:
        """(last batch in it, folder) of bases and deltas, oldest first; folders below a base are leftovers."""
        found = sorted((int(n.split("-")[1]), n.startswith("base-"), n) for n in list_names(self.spark, self.path)
                       if n.startswith(("base-", "delta-")) and list_names(self.spark, os.path.join(self.path, n)).count("_SUCCESS"))
        last_base = max((v for v, base, _ in found if base), default=-1)
        return [(v, n) for v, base, n in found if v > last_base or base and v == last_base]

    def read(self, before: int, touched: Sequence[int] | None = None) -> DataFrame | None:
        """The state before batch ``before`` (of the ``touched`` buckets); None if there is none."""
        parts = [(v, n) for v, n in self.versions() if v < before]
        if not parts:
            return None
        with_bucket = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        out = None
        for v, n in parts:
            part = self.spark.read.schema(with_bucket).parquet(os.path.join(self.path, n))
            if touched is not None:
                part = part.filter(F.col(BUCKET).isin([int(b) for b in touched]))
            part = part.withColumn(VERSION, F.lit(v))
            out = part if out is None else out.unionByName(part)
        if len(parts) > 1:
            # rows of a key and its versions: as many as one state has, times the deltas kept
            latest = F.max(VERSION).over(Window.partitionBy(BUCKET, self.key))
            out = out.withColumn("_latest", latest).filter(F.col(VERSION) == F.col("_latest"))
        return out.select(*self.schema.names)

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """The state of the keys that batch ``batch_id`` touched."""
        self._store(rows, f"delta-{batch_id}")
        self.compact(batch_id)

    def _store(self, rows: DataFrame, name: str) -> None:
        (rows.select(*self.schema.names).withColumn(BUCKET, self.bucket()).repartition(BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(os.path.join(self.path, name)))

    def compact(self, batch_id: int) -> None:
        """Merge all versions before ``batch_id`` once there are many; that batch itself may still run again."""
        before = [(v, n) for v, n in self.versions() if v < batch_id]
        if len(before) > self.compact_every:
            self._store(self.read(batch_id), f"base-{before[-1][0]}")
        kept = {n for _, n in self.versions()} | {f"delta-{batch_id}"}
        for name in list_names(self.spark, self.path):
            if name not in kept:
                delete_path(self.spark, os.path.join(self.path, name))


def touched_only(state: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return null_safe_join(state, keys.select(key).distinct(), [key], "left_semi")
