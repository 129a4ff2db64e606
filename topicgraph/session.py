"""Spark session helpers.

The library never creates a session behind the caller's back except through
``get_spark`` (tests, bench, CLI).  Iterative operators cut lineage with
reliable ``checkpoint()`` into the directory the cluster names in
``spark.checkpoint.dir``; only when that is unset on a local master do we set
a scratch directory of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str = "*", shuffle_partitions: int | None = None,
              app: str = "topicgraph") -> SparkSession:
    """Session used by tests and the bench: UTC, AQE on, UI off."""
    n = cpus if cpus != "*" else os.cpu_count() or 8
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; we
    refuse to invent a machine-local folder there.  On a local master (tests)
    a fresh scratch directory is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative graph operators need a "
            "shared checkpoint directory on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="topicgraph-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the reliable checkpoint directory (shared
    storage on a cluster) for intermediate files."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a job go when it ends: what the next jobs
    read is stored already."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` made once and read as a table of the scratch folder, which goes at
    the end.  Unlike a persisted one it is compressed, its readers take the
    columns they need, and what it was made from is off the disks."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        with shuffles_deleted(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
