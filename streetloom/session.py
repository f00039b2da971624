"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Needed for right results:
#   - JSON objects with a repeated key keep the last value instead of failing.
# Needed for speed at scale:
#   - adaptive execution splits skewed join partitions and sizes shuffles; the operators do
#     much work per byte, so small shuffles are not merged into a few tasks;
#   - page bodies are large, so Arrow batches are bounded by bytes as well as rows;
#   - filters reach the archive reader, which then skips the bodies nobody asked for.
SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.sql.python.filterPushdown.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; returns the session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_ROOT: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``.  Only a local session may go without
    it; there all tasks see the same disk, so one temporary folder serves the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="streetloom-"))
        root = _LOCAL_ROOT[0]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    """A path and the file system that Spark finds it on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified_path(spark: SparkSession, path: str) -> str:
    """A path with the scheme of the file system Spark finds it on; a plain one if that is local."""
    target, system = _place(spark, path or ".")
    text = system.makeQualified(target).toString()
    return text.removeprefix("file:") if text.startswith("file:/") else text


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a stage table that no later step reads."""
    target, system = _place(spark, path)
    system.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _place(spark, path)
    return system.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is missing."""
    target, system = _place(spark, path)
    if not system.exists(target):
        return []
    return [s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()]


@contextmanager
def scratch_folder(spark: SparkSession, label: str):
    """A fresh scratch folder that is removed at the end, also when a job fails."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        drop_path(spark, path)


@contextmanager
def read_by(spark: SparkSession, tasks: int):
    """Files are read by so many tasks or more, by those of all cores at least; the setting is put back."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, max(tasks, spark.sparkContext.defaultParallelism, int(before or 0)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
