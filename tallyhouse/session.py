"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE re-plans joins from measured sizes: it broadcasts a side only when the
# side is known to be small, and splits skewed partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the model graph has several hundred generated stages; the default of 100 recompiles them
    "spark.sql.codegen.cache.maxEntries": "2000",
    # call sites in error messages cost several JVM calls per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "tallyhouse",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the engine's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names, or a local one in local mode.

    The local one is made here, and goes when the program ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="tallyhouse-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path under the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def move_files(spark: SparkSession, source: str, target: str, prefix: str = "") -> None:
    """Move the data files of a folder of the shared storage, if it is there, into another; their names get a prefix."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    folder, to = at(source), at(target)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return
    files.mkdirs(to)
    for status in files.listStatus(folder):
        path = status.getPath()
        if path.getName()[0] not in "_." and not files.rename(path, at(to, prefix + path.getName())):
            raise OSError(f"can't move {path}")


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
