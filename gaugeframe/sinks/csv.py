"""CSV output of long and wide tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.numbers import float_text
from gaugeframe.operators.joins import BROADCAST_BYTES, measured_bytes
from gaugeframe.operators.reshape import column_dictionary
from gaugeframe.operators.selection import with_ordinal
from gaugeframe.schemas import CODE, VALUE, YEAR
from gaugeframe.storage import cut_lineage

# Missing is an empty field, quotes are doubled, spaces are kept.
CSV_FORMAT = {
    "nullValue": "",
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_long_csv(long: DataFrame, path: str) -> None:
    """Long table as a folder of CSV parts, each with a header line.

    The rows of a selection come from all tasks of a much larger scan; the
    rebalancing shuffle packs them into files of the advisory size and splits an
    indicator that exceeds it.
    """
    rows = long.withColumn(VALUE, float_text(F.col(VALUE))).hint("rebalance", CODE)
    rows.write.mode("overwrite").options(header=True, **CSV_FORMAT).csv(path)


def wide_csv_lines(
    cells: DataFrame, keys: Sequence[tuple[str, int]] | None = None, entity: str = "COUNTRY"
) -> DataFrame:
    """The lines of a wide CSV file in order, with their place (section, entity).

    Three header lines (codes, years, entity name) come before one line per
    entity.  A line is put together from the means of its entity and the commas
    between them, so the table needs no schema with a field per column, and the columns
    stay rows of a table.  Without ``keys`` they are those of the (stored) means.  One range
    partitioning serves both the grouping by entity and the order of the lines.
    """
    if keys is None:
        columns = column_dictionary(cells)
    else:
        listed = [(i, *key) for i, key in enumerate(keys)]
        columns = cells.sparkSession.createDataFrame(listed, f"ordinal long, {CODE} string, {YEAR} int")
    columns = cut_lineage(columns.select(CODE, YEAR, F.col("ordinal").cast("int").alias("place")))
    width = columns.count()
    ordered = columns.select(F.struct("place", _field(F.col(CODE)).alias("code"), F.col(YEAR).cast("string").alias("year")).alias("c"))
    names = ordered.agg(F.array_sort(F.collect_list("c")).alias("all"))

    def line(section: int, first: str, rest: Column) -> Column:
        text = F.concat(_field(F.lit(first)), F.when(F.size("all") > 0, F.concat(F.lit(","), rest)).otherwise(""))
        return F.struct(F.lit(section).alias("section"), text.alias("header"))

    lines = [line(0, CODE, F.array_join("all.code", ",")), line(1, YEAR, F.array_join("all.year", ","))]
    lines.append(line(2, entity, F.repeat(F.lit(","), F.size("all") - 1)))
    head = names.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
    if measured_bytes(columns) <= BROADCAST_BYTES:
        columns = F.broadcast(columns)
    text = F.coalesce(float_text(F.col(VALUE)), F.lit(""))
    placed = cells.join(columns, [CODE, YEAR]).select(
        F.lit(len(lines)).alias("section"),
        F.col(f"`{entity}`").alias("entity"),
        F.struct("place", text.alias("text")).alias("cell"),
    )
    parts = head.unionByName(placed, allowMissingColumns=True).repartitionByRange("section", "entity")
    rows = parts.groupBy("section", "entity").agg(
        F.first("header").alias("header"), F.array_sort(F.collect_list("cell")).alias("cells")
    )
    body = F.concat(_field(F.col("entity")), F.lit(","), _spaced(F.col("cells"), F.lit(width)))
    finished = F.when(F.col("section") < len(lines), F.col("header")).otherwise(body)
    return rows.select("section", "entity", finished.alias("line")).orderBy("section", "entity")


def wide_csv_lines_by_topic(cells: DataFrame, entities: Mapping[int, str]) -> DataFrame:
    """The lines of many wide CSV files at once, in order, with their place (topic, section, entity).

    ``cells`` are stored means marked by a number ``topic``, their places in a column ``entity``;
    ``entities`` has the name of that column for each topic.  Columns are numbered within their topic
    from one range sort of all of them, and one range partitioning by (topic, line) serves
    grouping and order, so neither jobs nor shuffles grow with the number of topics.
    """
    keys = ["topic", CODE, YEAR]
    columns = with_ordinal(cells.select(keys).distinct(), [F.col(k).asc() for k in keys])
    columns = cut_lineage(columns)
    widths = columns.groupBy("topic").agg(F.min("ordinal").alias("begin"), F.count("*").cast("int").alias("width"))
    # One row per topic.
    placed_columns = columns.join(F.broadcast(widths), "topic").select(
        *keys, (F.col("ordinal") - F.col("begin")).cast("int").alias("place"), "width"
    )
    placed_columns = cut_lineage(placed_columns)
    entry = F.struct("place", _field(F.col(CODE)).alias("code"), F.col(YEAR).cast("string").alias("year"))
    names = placed_columns.groupBy("topic").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    entity_name = F.element_at(F.create_map(*[F.lit(x) for pair in entities.items() for x in pair]), F.col("topic"))

    def line(section: int, first: Column, rest: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.concat(_field(first), F.lit(","), rest).alias("header"))

    lines = [
        line(0, F.lit(CODE), F.array_join("all.code", ",")),
        line(1, F.lit(YEAR), F.array_join("all.year", ",")),
        line(2, entity_name, F.repeat(F.lit(","), F.size("all") - 1)),
    ]
    head = names.select("topic", F.explode(F.array(*lines)).alias("line")).select("topic", "line.*")
    if measured_bytes(placed_columns) <= BROADCAST_BYTES:
        placed_columns = F.broadcast(placed_columns)
    text = F.coalesce(float_text(F.col(VALUE)), F.lit(""))
    body = cells.join(placed_columns, keys).select(
        "topic", F.lit(len(lines)).alias("section"), "entity", "width", F.struct("place", text.alias("text")).alias("cell")
    )
    order = ["topic", "section", "entity"]
    parts = head.unionByName(body, allowMissingColumns=True).repartitionByRange(*order)
    rows = parts.groupBy(*order).agg(
        F.first("header").alias("header"), F.first("width").alias("width"), F.array_sort(F.collect_list("cell")).alias("cells")
    )
    finished = F.concat(_field(F.col("entity")), F.lit(","), _spaced(F.col("cells"), F.col("width")))
    finished = F.when(F.col("section") < len(lines), F.col("header")).otherwise(finished)
    return rows.select(*order, finished.alias("line")).orderBy(*order)


def _field(text: Column) -> Column:
    return F.to_csv(F.struct(text.alias("field")), CSV_FORMAT)


def _spaced(cells: Column, width: Column) -> Column:
    """Texts of sorted cells, each after as many commas as it is places from the one before."""

    def field(cell: Column, i: Column) -> Column:
        previous = F.coalesce(F.get(cells, i - 1)["place"], F.lit(0))
        return F.concat(F.repeat(F.lit(","), cell["place"] - previous), cell["text"])

    rest = width - 1 - F.element_at(cells, -1)["place"]
    return F.concat(F.array_join(F.transform(cells, field), ""), F.repeat(F.lit(","), rest))


def write_wide_csv(
    cells: DataFrame,
    path: str,
    entity: str = "COUNTRY",
    keys: Sequence[tuple[str, int]] | None = None,
) -> None:
    """Means as a wide CSV file: text parts that form it when read in part order.

    The lines are range-sorted, so no task has to hold the whole table.  Without
    ``keys`` the means are stored and their columns looked up; means without any
    column give no file.
    """
    if keys is None:
        cells = cut_lineage(cells)
        if cells.isEmpty():
            return
    lines = wide_csv_lines(cells, keys, entity).select("line")
    lines.write.mode("overwrite").text(path)
