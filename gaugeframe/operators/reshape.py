"""Cleaning to the long table, averaging, and pivoting to the wide table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.numbers import data_error, mean_of, nan_to_null, whole_year
from gaugeframe.operators.means import exact_means
from gaugeframe.operators.selection import with_ordinal
from gaugeframe.schemas import CODE, NEEDED, SPATIAL, TIME, VALUE, YEAR, require_columns
from gaugeframe.storage import cut_lineage

NullPolicy = Literal["keys", "value"]


class WideKey(NamedTuple):
    """One column of the wide table."""

    code: str
    year: int

    @property
    def column(self) -> str:
        return f"{self.code}|{self.year}"


class TooManyColumnsError(ValueError):
    """The wide table would have more columns than allowed."""


def prune(observations: DataFrame) -> DataFrame:
    """Check for the needed columns and keep only these."""
    return require_columns(observations).select(*NEEDED)


def rename(observations: DataFrame, entity: str = "COUNTRY") -> DataFrame:
    """Give the place and time columns their output names."""
    return observations.withColumnsRenamed({SPATIAL: entity, TIME: YEAR})


def mark_missing(observations: DataFrame) -> DataFrame:
    """Turn NaN, of the value or of a fractional year column, into null."""
    fractional = [
        f.name
        for f in observations.schema
        if f.name in (TIME, VALUE) and isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return observations.withColumns({c: nan_to_null(F.col(c)) for c in fractional})


def drop_missing(renamed: DataFrame, entity: str, null_policy: NullPolicy) -> DataFrame:
    """Drop rows that lack a key (``keys``), or only those that lack the value (``value``).

    Under ``value`` a kept row without a year is an error of the data.
    """
    if null_policy == "keys":
        return renamed.dropna(how="any", subset=[entity, YEAR, CODE])
    if null_policy != "value":
        raise ValueError(f"unknown null policy {null_policy!r}")
    kept = renamed.dropna(subset=[VALUE])
    problem = data_error("observation with a value but without a year").cast(kept.schema[YEAR].dataType)
    return kept.withColumn(YEAR, F.coalesce(F.col(YEAR), problem))


def clean_long(
    observations: DataFrame,
    entity: str = "COUNTRY",
    null_policy: NullPolicy = "keys",
    lenient_year: bool = False,
) -> DataFrame:
    """Long table (entity, YEAR, IndicatorCode, NumericValue); one map-only step."""
    renamed = rename(mark_missing(prune(observations)), entity)
    kept = drop_missing(renamed, entity, null_policy)
    if isinstance(kept.schema[YEAR].dataType, T.IntegerType):
        return kept
    return kept.withColumn(YEAR, whole_year(F.col(YEAR), lenient_year))


def mean_cells(
    long: DataFrame, entity: str = "COUNTRY", scale: int | None = None, exact: bool = False
) -> DataFrame:
    """Unweighted mean per (entity, code, year) of the values that are present.

    Sums of doubles depend on the order of the rows, unless ``scale`` (see ``mean_of``) or
    ``exact`` (see ``exact_means``) is asked for.

    Missing values go first, so groups without any value vanish.  Each task
    averages before the shuffle, so a group with very many rows arrives as one
    row per task.
    """
    present = long.withColumn(VALUE, nan_to_null(F.col(VALUE))).dropna(
        how="any", subset=[entity, CODE, YEAR, VALUE]
    )
    if exact:
        return exact_means(present, [entity, CODE, YEAR], VALUE)
    return present.groupBy(entity, CODE, YEAR).agg(mean_of(F.col(VALUE), scale).alias(VALUE))


def column_dictionary(cells: DataFrame) -> DataFrame:
    """Table (ordinal, code, year) of the wide columns, however many there are."""
    keys = cells.select(CODE, YEAR).distinct()
    return with_ordinal(keys, [F.col(CODE).asc(), F.col(YEAR).asc()])


def wide_keys(cells: DataFrame, max_columns: int | None = None) -> list[WideKey]:
    """Sorted wide columns of ``cells``, which become fields of a schema on the driver.

    With ``max_columns`` more of them are an error; none is ever left out.
    """
    distinct = cells.select(CODE, YEAR).distinct().orderBy(CODE, YEAR)
    found = (distinct if max_columns is None else distinct.limit(max_columns + 1)).collect()
    if max_columns is not None and len(found) > max_columns:
        raise TooManyColumnsError(
            f"more than {max_columns} wide columns: raise max_columns, or keep the means as rows"
        )
    return [WideKey(r[CODE], r[YEAR]) for r in found]


def pivot_wide(
    cells: DataFrame,
    entity: str = "COUNTRY",
    keys: Sequence[tuple[str, int]] | None = None,
    max_columns: int | None = None,
) -> DataFrame:
    """One row per entity, one column ``code|year`` per key, both in order.

    Known ``keys`` give a stable schema and need no job; cells of other keys are
    left out, as are entities without any cell.  Without ``keys`` the cells are
    stored, so that finding the keys and pivoting read the observations once; cells
    without any key give an empty table of entities.  The cells are range-partitioned
    by entity once, which serves the pivot and the order of the rows; an entity
    has at most one cell per column.
    """
    if keys is None:
        cells = cut_lineage(cells)
        wanted = wide_keys(cells, max_columns)
        if not wanted:
            return cells.select(f"`{entity}`").limit(0)
    else:
        wanted = [WideKey(*k) for k in keys]
        if not wanted:
            raise ValueError("a wide table needs at least one column")
        cells = _cells_of_keys(cells, wanted)
    names = [k.column for k in wanted]
    labelled = cells.select(entity, F.concat_ws("|", CODE, YEAR).alias("__key"), VALUE)
    placed = labelled.repartitionByRange(F.col(f"`{entity}`"))
    spread = placed.groupBy(entity).pivot("__key", names).agg(F.first(VALUE))
    return spread.orderBy(F.col(f"`{entity}`"))


def _cells_of_keys(cells: DataFrame, keys: Sequence[WideKey]) -> DataFrame:
    """Cells of the given keys.

    Codes and years are tested one by one, which can reach the scan; pairs are
    tested only where the keys are not all combinations of the two.
    """
    codes, years = sorted({k.code for k in keys}), sorted({k.year for k in keys})
    kept = cells.filter(F.col(CODE).isin(codes) & F.col(YEAR).isin(years))
    if len(set(keys)) == len(codes) * len(years):
        return kept
    return kept.filter(F.concat_ws("|", CODE, YEAR).isin([k.column for k in keys]))


def unpivot_wide(wide: DataFrame, entity: str, keys: Sequence[tuple[str, int]]) -> DataFrame:
    """The cells of a wide table as rows again, absent cells left out."""
    cell = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(code).alias(CODE),
                    F.lit(year).cast("int").alias(YEAR),
                    F.col(f"`{WideKey(code, year).column}`").alias(VALUE),
                )
                for code, year in keys
            ]
        )
    )
    return wide.select(f"`{entity}`", cell.alias("cell")).select(f"`{entity}`", "cell.*").dropna(subset=[VALUE])
