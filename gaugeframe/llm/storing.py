"""Intermediate tables in the shared folder."""

from __future__ import annotations

import gc
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.storage import remove_path, scratch_path

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it again.

    Later jobs survive lost executors; column files are smaller than checkpoints.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table made by ``stored``; no later job may read it, nor a frame made of it."""
    remove_path(table.sparkSession, _paths.pop(table))


def small(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` for broadcasting if they are counted to be at most ``most``; else as they are."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def release(spark: SparkSession) -> None:
    """Let go of shuffles, broadcasts and checkpoints that no frame refers to any more.

    Spark removes them, and the memory and disk they take, only after the driver has collected
    its garbage, which may be long after the rounds of a loop have ended.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
