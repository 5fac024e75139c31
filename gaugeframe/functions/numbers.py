"""Numeric normalisation, means and text rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(column: Column) -> Column:
    """A missing measurement is null: ``avg`` skips null but not NaN."""
    return F.nullif(column, F.lit(float("nan")))


def mean_of(value: Column, scale: int | None = None) -> Column:
    """Unweighted mean of the values that are present.

    A sum of doubles depends on the order of the rows, so it may differ in the
    last digits between two runs.  With ``scale`` the values are summed as whole
    multiples of ``10**-scale``; the mean is then the same in every run.  Use it
    for measurements with a known number of decimals; sums beyond the range of a
    long are reported as an error.
    """
    if scale is None:
        return F.avg(value)
    units = F.rint(value * F.lit(float(10**scale))).cast(T.LongType())
    return F.sum(units).cast("double") / F.lit(float(10**scale)) / F.count(value)


def data_error(*message: Column | str) -> Column:
    """Error that stops the job, naming the partition it was found in.

    The partition number makes the expression non-deterministic.  The optimizer
    therefore leaves the check where it was written, and does not move it below a
    join, where it would meet rows that the join leaves out.
    """
    parts = [F.lit(m) if isinstance(m, str) else m.cast("string") for m in message]
    return F.raise_error(F.concat_ws("", *parts, F.lit(" (partition "), F.spark_partition_id(), F.lit(")")))


def input_error(*message: Column | str) -> Column:
    """Error that stops the job where a value of the input is used.

    Unlike ``data_error`` it lets the optimizer move a filter below it, so that stored
    folders are left unread, and what is not read cannot fail.
    """
    return F.raise_error(F.concat_ws("", *[F.lit(m) if isinstance(m, str) else m for m in message]))


def whole_year(column: Column, lenient: bool = False) -> Column:
    """Year as int: fractions are cut off, text that is not a whole number is an error.

    ``lenient=True`` turns unreadable text into null instead.
    """
    year = column.try_cast("int")
    if lenient:
        return year
    unreadable = year.isNull() & column.isNotNull()
    return F.when(unreadable, data_error("not a year: ", column).cast("int")).otherwise(year)


def float_text(column: Column) -> Column:
    """Shortest decimal text of a double, positional from 1e-4 up to 1e16.

    Spark writes ``1.0E7``; indicator files carry ``10000000.0``, and ``1e+16``
    or ``1.5e-05`` beyond those bounds.  The text reads back as the same double;
    from 1e16 on a Java runtime before 19 may give one digit more than needed.
    """
    text = column.cast("string")
    size = F.abs(column)
    digits = text.try_cast(T.DecimalType(38, 20)).cast("string")
    positional = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1)
    sign = F.when(exponent.startswith("-"), "-").otherwise("+")
    power = F.regexp_replace(exponent, "^-", "")
    power = F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power)
    scientific = F.concat(mantissa, F.lit("e"), sign, power)
    return (
        F.when(F.isnan(column), F.lit(None).cast("string"))
        .when(size == float("inf"), F.when(column > 0, "inf").otherwise("-inf"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(scientific)
    )
