"""Shared storage for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster such a folder would be lost together with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gaugeframe-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably; later jobs read it and survive lost executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder for one intermediate table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this job's own output or scratch, on whatever file system it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder within its file system; False if there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    system = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(old):
        return False
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")
    return True
