"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "driverlens", cpus: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DRIVERLENS_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes the intermediate tables made inside when it ends: for work whose result is stored by then."""
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            remove(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables; ``scratch_scope`` removes it, else it stays until
    whoever owns the shared folder clears it, as a lazy result may read it at any time.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local master
    may fall back to the machine's own temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if base:
        path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    elif context.master.startswith("local"):
        path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), label)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if stack := _scopes.__dict__.get("stack"):
        stack[-1].append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back: cuts the lineage, survives lost executors, stays columnar.

    Spark knows such a table by the size of its files, a tenth or less of what a broadcast of it takes on the
    driver. So it asks for a merge join; a frame that is small at any scale is broadcast by its own hint.
    """
    path = scratch_path(df.sparkSession, label)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")


def write(df: DataFrame, path: str, *partitions: str) -> None:
    """Add rows to a stored table. The shuffle files of the write go with it, not when the driver next collects garbage."""
    with _setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.mode("append").partitionBy(*partitions).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_files(spark: SparkSession):
    """Scans planned inside put some two thousand small files into a task instead of thirty."""
    return _setting(spark, "spark.sql.files.openCostInBytes", "64k")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store Spark reaches; none if it isn't there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in store.listStatus(folder)) if store.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, with all that is in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run_id(spark: SparkSession, state_dir: str) -> str:
    """The id of the run whose state a folder holds, drawn when the folder is new."""
    names = [n for n in children(spark, f"{state_dir}/run") if n.startswith("id=")]
    if names:
        return names[0].removeprefix("id=")
    fresh = uuid.uuid4().hex
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state_dir}/run/id={fresh}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return fresh
