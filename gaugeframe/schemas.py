"""Names, types and the column check of the indicator data model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and the next-page key of the page format.
CODE = "IndicatorCode"
NAME = "IndicatorName"
SPATIAL = "SpatialDim"
TIME = "TimeDim"
VALUE = "NumericValue"
YEAR = "YEAR"
ROWS = "value"
NEXT_LINK = "@odata.nextLink"
UNREADABLE = "__unreadable"
PROBLEM = "problem"
NEEDED = (SPATIAL, TIME, CODE, VALUE)

CATALOG = T.StructType([T.StructField(CODE, T.StringType()), T.StructField(NAME, T.StringType())])

# The year is text, so that an unreadable one is reported by the cast in
# ``clean_long`` and not lost as a null of the JSON reader.
OBSERVATION = T.StructType(
    [
        T.StructField(SPATIAL, T.StringType()),
        T.StructField(TIME, T.StringType()),
        T.StructField(CODE, T.StringType()),
        T.StructField(VALUE, T.DoubleType()),
    ]
)

# One row per stored response: the address, the code that was asked for (null
# for catalogue pages), the response status and the response text.
LANDED = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)


def page_schema(row: T.StructType) -> T.StructType:
    """Envelope of one page whose rows have the type ``row``, as it is read.

    Values are read as text, so that one that is not a number can be told from a missing
    one.  ``UNREADABLE`` gets a body that does not have this form.
    """

    def as_read(field: T.StructField) -> T.StructField:
        return T.StructField(field.name, T.StringType() if isinstance(field.dataType, T.DoubleType) else field.dataType)

    return T.StructType(
        [
            T.StructField(ROWS, T.ArrayType(T.StructType([as_read(f) for f in row]))),
            T.StructField(NEXT_LINK, T.StringType()),
            T.StructField(UNREADABLE, T.StringType()),
        ]
    )


class MissingColumnsError(ValueError):
    """The input lacks columns that the operator needs."""


def require_columns(df: DataFrame, needed: Iterable[str] = NEEDED) -> DataFrame:
    """Return ``df`` unchanged, or name every column it lacks; runs no job."""
    needed = list(needed)
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns {missing}; needed are {needed}")
    return df
