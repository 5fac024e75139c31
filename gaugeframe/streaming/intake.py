"""Landed pages as a file stream.

The decoding is that of the batch reader.  The checkpoint makes every landed file count once; the
addresses taken in so far are the state, so that a page landed again does not count twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeframe.operators.joins import BROADCAST_BYTES, measured_bytes
from gaugeframe.schemas import CODE, LANDED
from gaugeframe.sources.landing import OnError, OnMissing, fail_on_error, keep_ok, scan_observations
from gaugeframe.storage import cut_lineage

FOLDERS = 32
PART = "code_part"


def stream_landed(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of landing rows from a folder of JSON-lines files."""
    reader = spark.readStream.schema(LANDED)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def append_observations(
    landed: DataFrame,
    table_path: str,
    checkpoint_path: str,
    on_error: OnError = "skip",
    once: bool = True,
    tasks_per_code: int = 8,
    on_missing: OnMissing = "fail",
    folders: int = FOLDERS,
) -> StreamingQuery:
    """Decode what has landed since the last run, append it as parquet, and end.

    The table has a folder for each of ``folders`` parts of the codes, and ``read_intake`` reads it.  A batch
    adds at most ``tasks_per_code`` files to a folder, however many codes there are.  The rows of a code are
    dealt to as many tasks, so a code with a large share of the rows does not wait for one.  A table
    keeps the number of folders that it was begun with.

    With ``once`` the first accepted page of an address counts: failed pages do not, and
    what is appended cannot be taken back (``latest_pages`` has the last one, in batch).  Pages without an
    address all count.  The state is the addresses, kept by the checkpoint.
    """
    pages = {"skip": keep_ok, "fail": fail_on_error}[on_error](landed)
    if once:
        # Pages without an address get one of their own.
        named = F.coalesce(F.col("url"), F.concat(F.lit("\u0000"), F.uuid()))
        pages = pages.withColumn("__address", named).dropDuplicates(["__address"]).drop("__address")
    rows = scan_observations(pages, on_error, on_missing=on_missing)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(tasks_per_code))
    # The code goes last, where a column by which a table is partitioned would be.
    names = [c for c in rows.columns if c != CODE]
    placed = rows.select(*names, CODE, _part(folders).alias(PART)).repartition(F.col(PART), salt)
    writer = placed.writeStream.partitionBy(PART).outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint_path).format("parquet").start(table_path)


def read_intake(
    spark: SparkSession,
    path: str,
    codes: DataFrame | None = None,
    folders: int = FOLDERS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The observations taken in; with ``codes`` those of its distinct codes, from their folders only."""
    stored = spark.read.parquet(path)
    if codes is None:
        return stored.drop(PART)
    wanted = cut_lineage(codes.select(CODE).filter(F.col(CODE).isNotNull()).distinct())
    # The filter keeps every code, and tells the optimizer that they are a choice.
    wanted = wanted.select(_part(folders).alias(PART), CODE).filter(F.col(PART) >= 0)
    small = measured_bytes(wanted) <= broadcast_bytes
    met = stored.join(F.broadcast(wanted) if small else wanted, [PART, CODE], "left_semi")
    return met.select(*[F.col(f"`{c}`") for c in stored.columns if c != PART])


def _part(folders: int) -> Column:
    return F.pmod(F.xxhash64(CODE), F.lit(folders)).cast("int")
