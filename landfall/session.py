"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# All instants are UTC. A join or grouping must not inherit a coarser distribution: documents grouped after a
# join on their archive are spread by both keys, so that one huge archive is not the work of one task, and
# the join itself stays free to be split where it is skewed. Archives go to Python by size, not by number.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # Look-ups by a purge's names reach the Bloom filters one by one instead of as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # A stream's batch lists its files by path, which else is a task for each of them.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is only acceptable when driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="landfall-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/landfall-{label}-{uuid.uuid4().hex}"


def _on(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _on(spark, path)
    files.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, file = _on(spark, path)
    return files.exists(file)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, as Spark's readers name it."""
    files, file = _on(spark, path)
    return files.makeQualified(file).toString()


def paged_files(spark: SparkSession, path: str) -> Iterator[str]:
    """Paths of the files below a folder, as the store gives them."""
    files, folder = _on(spark, path)
    found = files.listFiles(folder, True)
    while found.hasNext():
        yield found.next().getPath().toString()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it is not there."""
    files, folder = _on(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()) if files.exists(folder) else []


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in it go when each has ended; else they stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh path for the intermediate tables of one job, gone when the job is done."""
    path = fresh_path(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)
