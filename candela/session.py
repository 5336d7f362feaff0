"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Observation, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "candela",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on.

    * UTC session zone: bar dates and event times carry no zone.
    * AQE on: coalesces the many small shuffles of bar-sized data, turns a
      shuffle join into a broadcast only after measuring the built side.
    * UI off: no web server.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Plans here have thousands of expressions; recording the call site of each takes longer than planning.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings this library needs on a session it did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read. Only
    where it is unset and the master is local (tests, a laptop), a private
    folder is made, set, and removed when Python ends. On any other master
    each executor would write to its own disk, so the unset setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        configured = tempfile.mkdtemp(prefix="candela-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file (a marker)."""
    p, fs = _hadoop_path(spark, path)
    fs.create(p, True).close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    p, fs = _hadoop_path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    root = checkpoint_root(spark)
    path = os.path.join(root, "candela", f"{name}-{uuid.uuid4().hex[:12]}")
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Folders that :func:`scratch_path` and :func:`materialize` make inside are deleted at the end.

    For jobs that have written their results elsewhere by then.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_path(spark, path)


def together(spark: SparkSession, *jobs) -> None:
    """Run independent outputs at the same time: a small one doesn't wait for the planning and commit of another.

    All end before this returns; then the first error is raised.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in done:
        job.result()


def observed(seen: Observation) -> dict:
    """What ``seen`` observed; nothing where Spark knew that there are no rows and left the plan out."""
    return seen.get if seen._jo.getRow().size() else {}


def materialize(df):
    """Cut the lineage of ``df`` at a point that several branches read.

    A plan that reads one intermediate result twice (for example block ends
    and the rows they are joined back to) would otherwise evaluate everything
    upstream twice: column pruning gives the two branches different inputs,
    so Spark cannot reuse the shuffle. The rows are written once as Parquet
    to a fresh folder under the shared checkpoint root (reliable storage: an
    executor loss does not lose them) and read back. Unlike
    ``checkpoint()``, which evaluates an uncached plan twice (once to count,
    once to write), this evaluates it once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._candela_stage = path
    return out


def discard(*stages) -> None:
    """Delete the folders of :func:`materialize` results that nothing reads any more.

    Spark removes the shuffle files of finished jobs when the driver's JVM
    collects their plans; it is asked to do so here, since a driver with a large
    heap may not for hours.
    """
    for df in stages:
        spark = df.sparkSession
        p, fs = _hadoop_path(spark, df._candela_stage)
        fs.delete(p, True)
        spark.sparkContext._jvm.System.gc()
