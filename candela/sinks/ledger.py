"""Which micro-batches have been written whole.

A micro-batch writes several tables. Every write replaces by key or by batch, so
a batch that stopped between two of them is simply run again; its marker is
written after the last table. A batch with a marker is not run twice, and a
reader that wants whole batches only asks :func:`committed`.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from candela.session import create_file, list_names, path_exists

FOLDER = "_batches"


def is_committed(spark: SparkSession, out_dir: str, batch_id: int) -> bool:
    return path_exists(spark, os.path.join(out_dir, FOLDER, f"batch_id={batch_id}"))


def commit(spark: SparkSession, out_dir: str, batch_id: int) -> None:
    create_file(spark, os.path.join(out_dir, FOLDER, f"batch_id={batch_id}"))


def committed(spark: SparkSession, out_dir: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in list_names(spark, os.path.join(out_dir, FOLDER)) if n.startswith("batch_id="))
