"""Collecting the observations of selected indicators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.operators.bloom import keep_possible
from gaugeframe.operators.joins import BROADCAST_BYTES, fits_tasks, join_on_key, measured_bytes
from gaugeframe.schemas import CODE
from gaugeframe.storage import cut_lineage


class NoDataError(RuntimeError):
    """There is nothing to work on."""


def observations_for(
    observations: DataFrame,
    selection: DataFrame,
    dedupe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    key: str = CODE,
) -> DataFrame:
    """Observations of the selected codes, in one scan.

    A code selected under two names is collected twice, as by one request per
    selected row; ``dedupe=True`` takes every code once.  ``key`` names the code
    column of the observations; landed pages (``key="code"``) can be chosen in
    the same way before their bodies are parsed.
    """
    # The filter keeps every code but null, which meets no observation; it tells the
    # optimizer that the codes are a choice, so that other stored folders are not read.
    # Stored, since it is measured and then joined.
    codes = cut_lineage(selection.select(F.col(CODE).alias(key))).filter(F.length(key) >= 0)
    if dedupe:
        codes = codes.distinct()
    size = measured_bytes(codes)
    if size <= broadcast_bytes:
        return observations.join(F.broadcast(codes), key, "left_semi" if dedupe else "inner")
    # Rows move, and may be whole page bodies: those of other codes are left behind first.
    near = keep_possible(observations, codes, key)
    # They are not sorted, as those of one code may be very many.
    hashed = fits_tasks(codes.sparkSession, size)
    if dedupe:
        # Each code is there once; a semi join would be moved below the filter before it.
        return join_on_key(near, codes, key, small=False, hashed=hashed)
    copies = codes.groupBy(key).agg(F.count("*").alias("copies"))
    return repeat_rows(join_on_key(near, copies, key, small=False, hashed=hashed), "copies")


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its column ``copies`` says, at least once; drops that column."""
    times = F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return df.withColumn("copy", times).drop(copies, "copy")


def indicators_without_data(
    selection: DataFrame,
    observations: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Selected indicators that have no observation.

    Only codes of the selection stay, each task keeps a code once before the
    shuffle, and the anti join meets each code once.
    """
    wanted = selection.select(CODE).distinct()
    held = join_on_key(observations.select(CODE), wanted, CODE, "left_semi", broadcast_bytes)
    return selection.join(held.distinct(), CODE, "left_anti")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns that a frame lacks become null."""
    if not frames:
        raise NoDataError("no frames to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ensure_not_empty(df: DataFrame, message: str = "no observations collected") -> DataFrame:
    """Return ``df`` unchanged, or raise ``NoDataError``; looks for one row only."""
    if df.isEmpty():
        raise NoDataError(message)
    return df
