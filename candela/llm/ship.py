"""Sends this package to the session's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import candela
from candela.session import prepare


def prepared(spark: SparkSession) -> SparkSession:
    """``spark`` with its settings, and with ``candela`` importable in all workers.

    The package's source goes out once for each Spark context by ``addPyFile``,
    so executors need no copy of the repository.
    """
    prepare(spark)
    sc = spark.sparkContext
    if getattr(sc, "_candela_sent", None) != sc.applicationId:
        root = os.path.dirname(candela.__file__)
        path = os.path.join(tempfile.mkdtemp(prefix="candela-package-"), "candela_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _dirs, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("candela", os.path.relpath(full, root)))
        sc.addPyFile(path)
        sc._candela_sent = sc.applicationId
    return spark
