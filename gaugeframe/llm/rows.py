"""Carrying rows with any columns beside the columns an operator makes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed_rows(rows: DataFrame, replaced: Iterable[str] = ()) -> DataFrame:
    """All columns as one struct ``row``, so that no name meets one of the operator's own.

    Columns named in ``replaced``, in any case, are left out.
    """
    gone = {name.lower() for name in replaced}
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in gone]
    return rows.select(F.struct(*kept).alias("row"))
