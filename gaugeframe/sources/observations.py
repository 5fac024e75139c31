"""The observation table, stored by indicator code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeframe.schemas import CODE


def write_observations(observations: DataFrame, path: str) -> None:
    """Store observations in one folder per indicator code.

    The rebalancing shuffle gives files of the advisory size: codes with few
    rows share a task, a code with very many rows is split over several.
    """
    balanced = observations.hint("rebalance", CODE)
    balanced.write.mode("overwrite").partitionBy(CODE).parquet(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Read stored observations; a join with a selection prunes the folders.

    Codes are text, also where they look like numbers.
    """
    stored = spark.read.parquet(path)
    stored_type = stored.schema[CODE].dataType.simpleString()
    if stored_type != "string":
        schema = f"{CODE} string, " + ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema if f.name != CODE
        )
        stored = spark.read.schema(schema).parquet(path)
    return stored
