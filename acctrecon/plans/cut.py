"""Lineage cuts.

The master list (S7) and the union of mappings (S15) are each read by four
or more later stages.  At a cut the stage is written as parquet under the
shared folder the cluster names in ``spark.checkpoint.dir`` and read back:
later stages then start from files that survive the loss of any executor,
carry real size statistics for AQE, and prune columns on read.  A session
without a checkpoint folder is an error: uncut, the later stages' plans grow
to tens of thousands of scans.  A machine-local temporary folder is never
used, and the folders go when the session ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    return root or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """For tests and local runs only: use the session's folder, and set
    ``fallback`` only when none is configured."""
    root = checkpoint_root(spark)
    if root is None:
        # spark.checkpoint.dir is a static setting; the context's folder is
        # the runtime one (Spark adds a unique subfolder under it)
        spark.sparkContext.setCheckpointDir(fallback)
        root = checkpoint_root(spark)
    return root


def run_folder(spark: SparkSession) -> str:
    """A fresh folder for one pipeline run's cuts, under the checkpoint root."""
    root = checkpoint_root(spark)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/acctrecon/{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    spark = df.sparkSession
    if folder is None:
        folder = run_folder(spark)
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    remove_at_exit(spark, folder)
    return spark.read.parquet(path)


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the driver's Hadoop file system delete ``folder`` when the
    session's JVM ends, so no cut outlives the session that wrote it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a run folder through the Hadoop file system the cluster uses
    (works for HDFS, object stores and local paths alike)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the files below ``folder``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(path).getLength())
