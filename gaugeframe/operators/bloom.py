"""Leaving out rows whose key is in no large table, before they are shuffled.

A Bloom filter of blocks of one word: a key sets four bits of the word that its hash names.  The
words are a table made by one aggregation, broadcast as a lookup, and tested with bit
operations, so the rows pass through generated code and stay where they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.operators.joins import BROADCAST_BYTES
from gaugeframe.storage import cut_lineage

WORD_BITS = 64
BITS_SET = 4
# Bits for each key, at best and at least; memory of a word in a broadcast lookup.
MOST_BITS, LEAST_BITS = 12, 4
WORD_BYTES = 48


def keep_possible(rows: DataFrame, keys: DataFrame, key: str, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among the ``keys``; none that is gets lost.

    About one in a hundred others stays at 12 bits for each key.  ``rows`` come back as they are if
    the filter would take more than ``most_bytes``.  Rows without a key go.
    """
    held = keys.select(F.col(key)).filter(F.col(key).isNotNull())
    count = held.agg(F.approx_count_distinct(key, 0.02)).first()[0]
    words = max(1, int(count * 1.1 * MOST_BITS) // WORD_BITS)
    if words * WORD_BYTES > most_bytes:
        words = most_bytes // WORD_BYTES
        if words * WORD_BITS < count * LEAST_BITS:
            return rows
    word, mask = _place(F.col(key), words)
    # One row per word that any key sets: at most ``words``.
    filled = cut_lineage(held.select(word.alias("__word"), mask.alias("__mask")).groupBy("__word").agg(F.bit_or("__mask").alias("__set")))
    names = [F.col(f"`{c}`") for c in rows.columns]
    word, mask = _place(F.col(f"`{key}`"), words)
    placed = rows.filter(F.col(f"`{key}`").isNotNull()).select(*names, word.alias("__word"), mask.alias("__mask"))
    met = placed.join(F.broadcast(filled), "__word")
    return met.filter(F.col("__set").bitwiseAND(F.col("__mask")) == F.col("__mask")).select(*names)


def _place(key: Column, words: int) -> tuple[Column, Column]:
    """The word of a key and the bits it sets there."""
    spread = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftright(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS_SET)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return F.pmod(F.xxhash64(key, F.lit(2)), F.lit(words).cast("long")), mask
