"""Sizes and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count("*").alias(name))


def shape(df: DataFrame) -> DataFrame:
    """One row with the number of rows and of columns."""
    return row_count(df).withColumn("n_columns", F.lit(len(df.columns)))


def preview(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the given order, merged from the first rows of each task."""
    return df.orderBy(*order).limit(n)
