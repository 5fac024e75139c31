"""The observation table clustered by code and entity, for many codes of few rows.

One folder per code suits a few thousand codes.  Here the rows are range-partitioned and sorted by
code, entity and year, so a file holds a run of codes, a large code fills files of its own, and
the statistics and Bloom filters of a file's row groups tell what they hold.  A table of
(code, file) names the files to open for a selection, however large it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.operators.facts import observations_for
from gaugeframe.operators.joins import BROADCAST_BYTES, join_on_key
from gaugeframe.schemas import CODE, SPATIAL, TIME, require_columns
from gaugeframe.storage import cut_lineage

GROUP_BYTES = 32 * 1024 * 1024
PAGE_ROWS = 20_000
# Selected codes up to this number are tested row group by row group.
PUSHED_CODES = 64


def write_clustered(
    observations: DataFrame, path: str, files: int | None = None, group_bytes: int = GROUP_BYTES, page_rows: int = PAGE_ROWS
) -> None:
    """Store observations below ``path``: the rows, and which files hold which code.

    A file is a range of (code, entity, year); without ``files`` adaptive execution packs the ranges
    into files of the advisory size.  Columns beside the needed ones are kept.
    """
    require_columns(observations, [CODE, SPATIAL, TIME])
    order = [CODE, SPATIAL, TIME]
    placed = observations.repartitionByRange(files, *order) if files else observations.repartitionByRange(*order)
    options = {
        f"parquet.bloom.filter.enabled#{CODE}": "true",
        f"parquet.bloom.filter.enabled#{SPATIAL}": "true",
        "parquet.block.size": str(group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
    }
    placed.sortWithinPartitions(*order).write.mode("overwrite").options(**options).parquet(f"{path}/rows")
    rows = observations.sparkSession.read.parquet(f"{path}/rows")
    held = rows.groupBy(CODE, F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    held.filter(F.col(CODE).isNotNull()).write.mode("overwrite").parquet(f"{path}/codes")


def stored_codes(spark: SparkSession, path: str) -> DataFrame:
    """Codes of a clustered table with their numbers of rows, without reading the rows."""
    held = _codes(spark, path)
    return held.groupBy(CODE).agg(F.sum("n").alias("n"))


def read_clustered(
    spark: SparkSession,
    path: str,
    selection: DataFrame | None = None,
    dedupe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The observations of a clustered table, of the selected codes as ``observations_for`` has them.

    Files without a selected code are not opened; of a few codes the row groups are tested as
    well.  The names of the files reach the driver, as those of any table that is read.
    """
    whole = spark.read.parquet(f"{path}/rows")
    if selection is None:
        return whole
    chosen = cut_lineage(selection.select(CODE))
    codes = chosen.filter(F.col(CODE).isNotNull()).distinct()
    held = join_on_key(_codes(spark, path), codes, CODE, "left_semi", broadcast_bytes)
    files = sorted(r["file"] for r in held.select("file").distinct().collect())
    if not files:
        return observations_for(whole.filter("false"), chosen, dedupe, broadcast_bytes)
    rows = spark.read.schema(whole.schema).parquet(*[f"{path}/rows/{f}" for f in files])
    few = [r[CODE] for r in codes.limit(PUSHED_CODES + 1).collect()]
    if len(few) <= PUSHED_CODES:
        # Single tests reach the statistics and Bloom filters; of a longer list only its range would.
        rows = rows.filter(reduce(lambda a, b: a | b, [F.col(CODE) == c for c in sorted(few)]))
    return observations_for(rows, chosen, dedupe, broadcast_bytes)


def clustered_without_data(spark: SparkSession, path: str, selection: DataFrame) -> DataFrame:
    """Selected indicators that a clustered table has no rows of; reads the list of codes only."""
    held = _codes(spark, path).select(CODE).distinct()
    return selection.join(held, CODE, "left_anti")


def _codes(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(CODE, T.StringType()), T.StructField("file", T.StringType()), T.StructField("n", T.LongType())])
    return spark.read.schema(schema).parquet(f"{path}/codes")
