"""Spark session and shared-folder helpers.

Intermediate tables (indexes, materialised fixtures, lineage cuts) go to the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is absent (local tests, the smoke driver) do we create our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "quire", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for."""
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session; when it is unset (tests,
    local smoke runs) a folder is created and registered as the checkpoint dir,
    so ``DataFrame.checkpoint()`` and our written tables land in one place.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # the context appends a per-application uuid folder; use its parent
        return current.rstrip("/").rsplit("/", 1)[0]
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="quire-work-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    The sources (a few hundred kB) are zipped and handed to the session once per
    application; executors fetch them through Spark, whatever their working
    folder and ``PYTHONPATH`` are.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quire-zip-"), "quire.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under the shared folder; unique by default so nothing is overwritten."""
    base = work_dir(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/{leaf}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path, 0 if it is not there."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete what is at a path, if anything, through the Hadoop file system."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path without scheme if it is in a local file system, else None."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(jpath).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def materialize(df, name: str):
    """Write ``df`` once to a fresh folder under the shared folder and read it
    back: a lineage cut that survives executor loss and, unlike
    ``DataFrame.checkpoint()``, computes the input a single time."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def overwriting_partitions(spark: SparkSession):
    """Inside, an overwrite replaces the partitions that it has rows for and leaves the
    others as they are."""
    return _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")


def files_side_by_side(spark: SparkSession, files: int):
    """Inside, a task that writes at most so many files has them open together, instead of
    sorting its rows by file first. (Beyond that Spark sorts the rest.)"""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(files + 1))


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 512 << 20) -> dict[str, str]:
    """Settings for a cluster run, derived from the input size.

    - scan splits of ``target_partition_bytes / 2`` (texts expand several
      times when tokenised, so splits stay small enough to aggregate in memory);
    - shuffle partitions so that one partition holds ~``target_partition_bytes``
      of the largest shuffle (the counted terms of the index build, below the
      input size), never fewer than 3 waves of tasks; AQE coalesces the
      smaller shuffles of later stages;
    - AQE skew handling with thresholds relative to that partition size.
    """
    slots = executors * cores_per_executor
    shuffle_parts = max(3 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # query-side tables are broadcast only after an explicit row-count check
        "quire.broadcast.maxRows": "2000000",
    }
