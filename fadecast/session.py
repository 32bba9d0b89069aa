"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fadecast")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FADECAST_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every query relies on for its results.

    Timestamps are zone-free, so the session zone must not shift them. Skewed
    join partitions are split by adaptive execution.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    # Sums of vectors are object aggregates; their buffers are small beside a task's memory.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder on this machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not current:
            sc.setCheckpointDir(named)
        return named
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="fadecast-ckpt-")
    sc.setCheckpointDir(path)
    return path


_made: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for one written table.

    What is written there is deleted when the driver's process ends.
    """
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _made:
        # Registered while the gateway runs, so it is called before the gateway is closed.
        atexit.register(_forget, spark.sparkContext._gateway.jvm)
    _made.append(path)
    return path


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``shared_path`` that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    if path in _made[1:]:  # the first one stands for the registration
        _made.remove(path)


def _forget(jvm) -> None:
    for name in _made:
        try:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
        except Exception:  # the driver's JVM is gone, or its store is: nothing left to do
            return


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from there.

    Used where two branches must see the very same rows in the very same
    partitions; a lost executor then costs a re-read, not a recomputation.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
