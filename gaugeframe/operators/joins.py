"""Key joins that hold when one key has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.storage import cut_lineage

BROADCAST_BYTES = 32 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the memory for the rows of ``df``, from its data."""
    width = F.lit(32)
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 16
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def join_on_key(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    small: bool | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Join many ``rows`` with a ``lookup`` that has each key once (inner or left_semi).

    A lookup measured as small is broadcast, so the rows are not shuffled.  Otherwise both
    sides are shuffled once; the lookup is stored first, so that its side is a plain shuffle
    too and adaptive execution can split a key that has a large share of the rows, with the
    lookup row of that key copied to each part.  The rows are read once in either case.
    ``small`` passes on a size check already made.  With ``hashed`` a task holds its part of
    the lookup, and does not sort the rows (``fits_tasks`` tells whether it may).
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    if small is None:
        small = measured_bytes(lookup) <= broadcast_bytes
    if small:
        return rows.join(F.broadcast(lookup), key, how)
    return rows.join(cut_lineage(lookup).filter(F.col(key).isNotNull()).hint("shuffle_hash" if hashed else "merge"), key, how)


def fits_tasks(spark: SparkSession, size: int) -> bool:
    """Whether a lookup of ``size`` bytes, dealt to the tasks of a shuffle, can be held by them."""
    return size <= BROADCAST_BYTES * int(spark.conf.get("spark.sql.shuffle.partitions"))
