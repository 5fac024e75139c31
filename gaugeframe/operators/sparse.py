"""Wide tables of any width: sorted cells of an entity in blocks of columns, and a dictionary of the columns.

A schema has a field per column and lies on the driver, so it ends at some tens of thousands.  Here
columns have numbers; an entity has, for each block of columns in which it has a value, the places of its
cells and their values.  Blocks are folders: a slice of the columns reads only its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.operators.joins import BROADCAST_BYTES, measured_bytes
from gaugeframe.operators.reshape import WideKey, column_dictionary
from gaugeframe.schemas import CODE, VALUE, YEAR
from gaugeframe.storage import cut_lineage

BLOCK = 4096
_ROWS = "entity string, places array<int>, values array<double>, block int"


def write_sparse(cells: DataFrame, path: str, entity: str = "COUNTRY", block: int = BLOCK) -> None:
    """Store means (entity, code, year, value) as sparse rows below ``path``.

    Columns are numbered by code and year.  A group has at most ``block`` cells; rows of a block are
    sorted by entity.  Cells without entity, code or year are an error of the caller's and left out.
    """
    cells = cut_lineage(cells.dropna(subset=[entity, CODE, YEAR]))
    columns = cut_lineage(column_dictionary(cells))
    spark = cells.sparkSession
    columns.select("ordinal", CODE, YEAR).orderBy("ordinal").write.mode("overwrite").parquet(f"{path}/columns")
    spark.range(1).select(F.lit(block).alias("block")).write.mode("overwrite").parquet(f"{path}/settings")
    small = measured_bytes(columns) <= BROADCAST_BYTES
    placed = cells.join(F.broadcast(columns) if small else columns, [CODE, YEAR]).select(
        F.col(f"`{entity}`").alias("entity"),
        (F.col("ordinal") / block).cast("int").alias("block"),
        F.struct((F.col("ordinal") % block).cast("int").alias("place"), F.col(VALUE).alias("value")).alias("cell"),
    )
    # One range partitioning serves grouping, order and the folders.
    parts = placed.repartitionByRange("block", "entity")
    rows = parts.groupBy("block", "entity").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    rows = rows.select("entity", F.col("cells.place").alias("places"), F.col("cells.value").alias("values"), "block")
    rows.sortWithinPartitions("block", "entity").write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows")


def sparse_columns(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary (ordinal, code, year) of a sparse table."""
    return spark.read.schema(f"ordinal long, {CODE} string, {YEAR} int").parquet(f"{path}/columns")


def sparse_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows as stored: ``entity``, ``block``, sorted ``places`` within it and their ``values``."""
    return spark.read.schema(_ROWS).parquet(f"{path}/rows")


def sparse_cells(spark: SparkSession, path: str, entity: str = "COUNTRY") -> DataFrame:
    """The means of a sparse table as rows again."""
    size = _block(spark, path)
    cell = F.explode(F.arrays_zip("places", "values")).alias("cell")
    flat = sparse_rows(spark, path).select("entity", "block", cell)
    ordinal = F.col("block").cast("long") * size + F.col("cell.places")
    flat = flat.select("entity", ordinal.alias("ordinal"), F.col("cell.values").alias(VALUE))
    columns = sparse_columns(spark, path)
    small = measured_bytes(columns) <= BROADCAST_BYTES
    joined = flat.join(F.broadcast(columns) if small else columns, "ordinal")
    return joined.select(F.col("entity").alias(entity), CODE, YEAR, VALUE)


def sparse_slice(spark: SparkSession, path: str, first: int, count: int, entity: str = "COUNTRY") -> DataFrame:
    """The columns ``first`` to ``first + count - 1`` as a wide table, of the entities with a cell in them.

    Only the blocks of these columns are read; one block needs no shuffle but that of the order.
    """
    size = _block(spark, path)
    wanted = sparse_columns(spark, path).filter((F.col("ordinal") >= first) & (F.col("ordinal") < first + count))
    keys = {r["ordinal"]: WideKey(r[CODE], r[YEAR]).column for r in wanted.collect()}  # the caller's schema
    blocks = sorted({o // size for o in keys})
    rows = sparse_rows(spark, path).filter(F.col("block").isin(blocks))
    if not keys:
        return rows.select(F.col("entity").alias(entity)).limit(0)

    def value(ordinal: int):
        place = F.array_position("places", F.lit(ordinal % size).cast("int"))
        found = F.when((F.col("block") == ordinal // size) & (place > 0), F.element_at("values", place.cast("int")))
        return found.alias(keys[ordinal])

    spread = rows.select(F.col("entity").alias(entity), *[value(o) for o in sorted(keys)])
    if len(blocks) > 1:
        spread = spread.groupBy(entity).agg(*[F.max(f"`{keys[o]}`").alias(keys[o]) for o in sorted(keys)])
    return spread.filter(F.coalesce(*[F.col(f"`{keys[o]}`") for o in sorted(keys)]).isNotNull()).orderBy(F.col(f"`{entity}`"))


def _block(spark: SparkSession, path: str) -> int:
    return spark.read.schema(T.StructType([T.StructField("block", T.IntegerType())])).parquet(f"{path}/settings").first()["block"]
