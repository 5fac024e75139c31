"""Sharding by a permutation-filled lookup table.

Every shard has a preference order of the slots of a prime-sized table: an offset and a
step, both from a hash of its name.  The shards take turns and claim their next free
slot until the table is full.  A key's slot is its hash modulo the size of the table, so
placing a row is one look-up.  Removing a shard frees its slots and moves few others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.rows import packed_rows

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 1_000_003


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """For each slot the index of its shard.

    ``size`` is a prime of at most ``MAX_TABLE_SIZE`` and not less than the number of
    shards; the table is small whatever the number of rows.  Names are distinct.
    """
    if not 1 <= len(shards) <= size <= MAX_TABLE_SIZE or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, at least one, and no more than slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the number of slots has to be a prime")
    place = [_hashed(name, "offset") % size for name in shards]
    step = [_hashed(name, "step") % (size - 1) + 1 for name in shards]
    table = np.full(size, -1, np.int32)
    filled = 0
    while True:
        for shard in range(len(shards)):
            slot = place[shard]
            while table[slot] >= 0:
                slot = (slot + step[shard]) % size
            table[slot] = shard
            place[shard] = (slot + step[shard]) % size
            filled += 1
            if filled == size:
                return table


def _hashed(name: str, purpose: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{purpose}:{name}".encode()).digest()[:8], "big")


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: 60 bits of a digest of its text, modulo the table; null is the empty text."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(size).cast("long"))


def assign_shards(
    rows: DataFrame,
    shards: Sequence[str],
    key: str = "doc_id",
    size: int = TABLE_SIZE,
    slot_column: str = "slot",
    shard_column: str = "shard",
) -> DataFrame:
    """Add the slot and the shard of every row; rows are neither moved nor dropped.

    The table has ``size`` rows at most ``MAX_TABLE_SIZE`` and is broadcast.  Equal keys,
    repeated rows and null keys have one shard each.  Columns that have one of the two new
    names already are replaced.
    """
    table = pd.DataFrame({"place": np.arange(size), "shard": lookup_table(shards, size)})
    table["shard"] = [shards[i] for i in table["shard"]]
    places = rows.sparkSession.createDataFrame(table, "place long, shard string")
    packed = packed_rows(rows, [slot_column, shard_column])
    placed = packed.withColumn("place", slot_of(F.col(f"row.`{key}`"), size)).join(F.broadcast(places), "place")
    return placed.select("row.*", F.col("place").alias(slot_column), F.col("shard").alias(shard_column))


def write_shards(placed: DataFrame, path: str, shard_column: str = "shard") -> None:
    """One folder of files per shard; large shards are written by several tasks."""
    balanced = placed.hint("rebalance", shard_column)
    balanced.write.mode("errorifexists").partitionBy(shard_column).parquet(path)
