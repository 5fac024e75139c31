"""Turns of conversations as light rows: what tells them apart, without their texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn's role and text; the length keeps the two apart."""
    size = F.length(role).cast("string")
    return F.unhex(F.md5(F.concat(size, F.lit(":"), role, text).cast("binary")))


def turn_order(turn: str = "turn", tie: str = "digest") -> list[Column]:
    """Order within a conversation: by turn, null first, rows of one turn by their digest."""
    return [F.col(turn).asc_nulls_first(), F.col(tie).asc()]
