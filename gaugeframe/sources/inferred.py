"""All columns of response rows, found from the data.

Rows are parsed as variants; one aggregate merges the types of all their fields, and the result
is a table with a column per field.  Numbers of different types become doubles, fields
whose types have nothing in common become text, and so do nested ones (as JSON).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.numbers import input_error
from gaugeframe.operators.facts import NoDataError, union_all
from gaugeframe.schemas import CODE, PROBLEM, ROWS, UNREADABLE
from gaugeframe.sources.landing import OnError, OnMissing, OnUnreadable, fail_on_error, keep_ok

ENTRY = "__entry"
_PAGE = f"`{ROWS}` ARRAY<VARIANT>, `{UNREADABLE}` STRING"
_QUOTED_OR_OBJECT = re.compile(r"(`(?:[^`]|``)*`)|OBJECT<")


def variant_rows(
    landed: DataFrame,
    on_error: OnError = "skip",
    on_unreadable: OnUnreadable = "fail",
    on_missing: OnMissing = "none",
    keep: Sequence[str] = ("code",),
) -> DataFrame:
    """One row per entry of ``value`` as a variant, beside the columns ``keep`` of its page.

    Bodies that are no pages, and entries that are no objects, stop the job, or with ``mark`` stay as
    rows with a ``problem``; null entries are left out.
    """
    accepted = {"skip": keep_ok, "fail": fail_on_error}[on_error](landed)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    pages = accepted.select(*keep, F.from_json("body", _PAGE, options).alias("page"))
    rows, bad = F.col(f"page.{ROWS}"), F.col(f"page.{UNREADABLE}").isNotNull()
    missing = rows.isNull() & F.lit(on_missing == "fail")
    problem = F.when(bad, "not a page").when(missing, "no rows")
    entries = pages.select(*keep, problem.alias(PROBLEM), F.explode_outer(rows).alias(ENTRY))
    # A null entry of the list is a variant that holds null, and nothing to keep.
    entries = entries.filter(F.col(PROBLEM).isNotNull() | (F.col(ENTRY).isNotNull() & ~F.is_variant_null(ENTRY)))
    other = F.col(PROBLEM).isNull() & ~F.schema_of_variant(ENTRY).startswith("OBJECT")
    entries = entries.withColumn(PROBLEM, F.when(other, "row is not an object").otherwise(F.col(PROBLEM)))
    if on_unreadable == "mark":
        return entries.withColumn(ENTRY, F.when(F.col(PROBLEM).isNull(), F.col(ENTRY)))
    stop = input_error("unreadable page (", F.col(PROBLEM), ")").cast("variant")
    return entries.select(*keep, F.when(F.col(PROBLEM).isNull(), F.col(ENTRY)).otherwise(stop).alias(ENTRY))


def infer_types(entries: DataFrame) -> T.StructType:
    """Fields of the variant rows in the order of their names, each with one type that holds all its values.

    The types are merged task by task; what reaches the driver is the schema.
    """
    found = entries.agg(F.schema_of_variant_agg(ENTRY).alias("types")).first()["types"]
    if found is None or not found.startswith("OBJECT<"):
        return T.StructType([])
    types = T._parse_datatype_string(_QUOTED_OR_OBJECT.sub(lambda m: m.group(1) or "STRUCT<", found))
    return T.StructType([T.StructField(f.name, _column_type(f.dataType)) for f in types])


def _column_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.LongType, T.BooleanType, T.DoubleType)):
        return kind
    return T.DoubleType() if isinstance(kind, (T.DecimalType, T.FloatType)) else T.StringType()


def typed_rows(entries: DataFrame, types: T.StructType) -> DataFrame:
    """The variant rows as columns of the given types, beside the other columns.

    A value that its column cannot hold, of a schema that was not inferred from these rows, is
    an error.  Field names that differ in case only need ``spark.sql.caseSensitive``.
    """
    others = [F.col(f"`{c}`") for c in entries.columns if c not in (ENTRY, *types.names)]
    return entries.select(*others, *[_field(f).alias(f.name) for f in types])


def _field(field: T.StructField) -> Column:
    quote = '"' if "'" in field.name else "'"
    if quote in field.name:
        raise ValueError(f"field name with both kinds of quotes: {field.name!r}")
    return F.variant_get(ENTRY, f"$[{quote}{field.name}{quote}]", field.dataType.simpleString())


def infer_rows(
    landed: DataFrame,
    on_error: OnError = "skip",
    on_missing: OnMissing = "none",
    types: T.StructType | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Observations of all landed pages with every column that a row has, stamped with the requested code.

    The bodies are parsed once to find the types, unless they are given, and once to
    read the rows.  ``required`` columns are there, as null text, even if no row has them.
    """
    entries = variant_rows(landed, on_error, on_missing=on_missing)
    types = infer_types(entries) if types is None else types
    lacking = [T.StructField(n, T.StringType()) for n in required if n not in types.names]
    types = T.StructType([f for f in [*types, *lacking] if f.name != CODE])
    return typed_rows(entries.withColumnRenamed("code", CODE), types)


def unreadable_entries(landed: DataFrame, on_error: OnError = "skip") -> DataFrame:
    """Address, code and problem of what ``infer_rows`` cannot read, and of pages without rows."""
    rows = variant_rows(landed, on_error, "mark", "fail", ("url", "code"))
    return rows.filter(F.col(PROBLEM).isNotNull()).select("url", "code", PROBLEM)


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both: doubles for numbers, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    numeric = all(isinstance(t, T.NumericType) for t in (a, b))
    whole = numeric and all(isinstance(t, T.IntegralType) for t in (a, b))
    return T.LongType() if whole else T.DoubleType() if numeric else T.StringType()


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns of different types get one that holds all values."""
    if not frames:
        raise NoDataError("no frames to stack")
    types: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            types.setdefault(field.name, []).append(field.dataType)
    wide = {name: reduce(widest, kinds) for name, kinds in types.items()}
    alike = [
        f.select(*[F.col(f"`{x.name}`").cast(wide[x.name]).alias(x.name) if x.dataType != wide[x.name] else F.col(f"`{x.name}`") for x in f.schema])
        for f in frames
    ]
    return union_all(alike)
