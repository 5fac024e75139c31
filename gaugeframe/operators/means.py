"""Sums and means of doubles that do not depend on the order of the rows.

A double is a whole number of 53 bits times a power of two.  Cut at fixed powers of two, it
becomes three whole numbers of 28 bits, the digits of a very long number in base 2**28.  Digits are
added as longs, which is exact in any order, so partial sums can be merged as they come:
from tasks, from files, from one day to the next.  Only the finished sum is rounded, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 28
BASE = 1 << BITS
# Bins that small numbers are lifted by before they are cut, so that no step meets denormal numbers.
LIFT = 20
TINY = 2.0**-400

_DIGITS = ("high", "middle", "low")
_COUNTS = ("n", "plus_infinite", "minus_infinite")
BIN = "bin"


def sum_states(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Partial sums per key and bin, of the values that are neither null nor NaN.

    A mergeable table: a key has a row per bin of 28 binary places in which its values
    begin, few as a rule and 77 at most.  Each task adds before the shuffle.  A digit sum
    beyond the range of a long (more than 2**34 values of one key and bin) is an error.
    """
    x = F.col(f"`{value}`").cast("double")
    present = rows.filter(x.isNotNull() & ~F.isnan(x))
    size = F.abs(x)
    finite = size < float("inf")
    tiny = finite & (size < TINY)
    lifted = F.when(~finite, 0.0).when(tiny, x * F.lit(2.0 ** (BITS * LIFT))).otherwise(x)
    cut = present.select(*[F.col(f"`{k}`") for k in keys], x.alias("__x"), lifted.alias("__lifted"), tiny.alias("__tiny"))
    place = F.when(F.col("__lifted") == 0, 0).otherwise(F.floor(F.log2(F.abs("__lifted")) / BITS)).cast("int")
    cut = cut.withColumn("__place", place)
    cut = cut.withColumn("__unit", F.pow(F.lit(2.0), F.col("__place") * BITS))
    # Each step takes the whole part and leaves the rest, both exactly.
    for digit in _DIGITS:
        whole = (F.col("__lifted") / F.col("__unit")).cast("long")
        cut = cut.withColumn(digit, whole).withColumn("__lifted", F.col("__lifted") - F.col(digit) * F.col("__unit"))
        cut = cut.withColumn("__unit", F.col("__unit") / BASE)
    infinite = [F.when(F.col("__x") == s, 1).otherwise(0).cast("long").alias(c) for c, s in zip(_COUNTS[1:], (float("inf"), float("-inf")))]
    place = F.when(F.col("__tiny") & (F.col("__x") != 0), F.col("__place") - LIFT).otherwise(F.col("__place"))
    parts = cut.select(*[F.col(f"`{k}`") for k in keys], place.alias(BIN), *_DIGITS, F.lit(1).cast("long").alias("n"), *infinite)
    return merge_states(parts, keys)


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial sums of several tables, stacked, as one."""
    names = [F.col(f"`{k}`") for k in keys]
    return states.groupBy(*names, BIN).agg(*[F.sum(c).alias(c) for c in (*_DIGITS, *_COUNTS)])


def finished_sums(states: DataFrame, keys: Sequence[str], total: str = "total", count: str = "n") -> DataFrame:
    """Per key the sum, rounded once to the nearest double, and the number of its values.

    Infinite values give an infinite sum, or NaN if both are there.  Sums below the smallest normal
    double may be rounded twice.
    """
    names = [F.col(f"`{k}`") for k in keys]
    parts = F.collect_list(F.struct(BIN, *_DIGITS)).alias("__parts")  # one per bin, at most 77
    held = states.groupBy(*names).agg(parts, *[F.sum(c).alias(f"__{c}") for c in _COUNTS])
    low = F.array_min(F.col(f"__parts.{BIN}")) - (len(_DIGITS) - 1)
    places = F.sequence(low, F.array_max(F.col(f"__parts.{BIN}")))

    def digit_at(p: Column) -> Column:
        def add(acc: Column, part: Column) -> Column:
            for i, name in enumerate(_DIGITS):
                acc = acc + F.when(part[BIN] - i == p, part[name]).otherwise(F.lit(0).cast("long"))
            return acc

        return F.aggregate("__parts", F.lit(0).cast("long"), add)

    held = held.withColumn("__low", low).withColumn("__digits", F.transform(places, digit_at))
    held = held.withColumn("__up", _carried(F.col("__digits")))
    negative = F.col("__up.carry") < 0
    turned = _carried(F.transform("__digits", lambda d: -d))
    held = held.withColumn("__negative", negative).withColumn("__up", F.when(negative, turned).otherwise(F.col("__up")))
    # Highest digit first; the last carry is the highest of all.
    held = held.withColumn("__digits", F.reverse(F.array_append("__up.digits", F.col("__up.carry"))))
    first = F.array_position(F.transform("__digits", lambda d: d != 0), True).cast("int")
    held = held.withColumn("__first", first)

    def digit(offset: int) -> Column:
        return F.coalesce(F.get("__digits", F.col("__first") - 1 + offset), F.lit(0).cast("long")).cast("decimal(38,0)")

    # Three digits hold 57 bits at least; whether anything follows them decides between two neighbours.
    rest = F.slice("__digits", F.col("__first") + 3, F.size("__digits"))
    follows = F.exists(rest, lambda d: d != 0).cast("int").cast("decimal(38,0)")
    base = F.lit(BASE).cast("decimal(10,0)")
    leading = ((digit(0) * base + digit(1)).cast("decimal(38,0)") * base + digit(2)).cast("decimal(38,0)")
    whole = (leading * F.lit(2).cast("decimal(1,0)") + follows).cast("decimal(38,0)").cast("double")
    # Place of the third digit, and one bit for what follows.
    power = (F.col("__low") + F.size("__digits") - F.col("__first") - 2) * BITS - 1
    half = F.floor(power / 2)
    scaled = whole * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)
    signed = F.when(F.col("__first") == 0, 0.0).when(F.col("__negative"), -scaled).otherwise(scaled)
    plus, minus = F.col("__plus_infinite") > 0, F.col("__minus_infinite") > 0
    result = F.when(plus & minus, float("nan")).when(plus, float("inf")).when(minus, float("-inf")).otherwise(signed)
    return held.select(*names, result.alias(total), F.col("__n").alias(count))


def _carried(digits: Column) -> Column:
    """Digits from 0 to 2**28 - 1, lowest first, and the carry beyond the highest, which has the sign."""

    def step(acc: Column, d: Column) -> Column:
        value = d + acc["carry"]
        rest = F.pmod(value, F.lit(BASE).cast("long"))
        carry = F.shiftright(value - rest, BITS)
        return F.struct(F.array_append(acc["digits"], rest).alias("digits"), carry.alias("carry"))

    start = F.struct(F.array().cast("array<bigint>").alias("digits"), F.lit(0).cast("long").alias("carry"))
    return F.aggregate(digits, start, step)


def exact_means(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Unweighted mean per key: the sum of the values, rounded once, divided by their number.

    Bit for bit the same under any order and partitioning of the rows.  Keys without a value vanish.
    """
    sums = finished_sums(sum_states(rows, keys, value), keys, "__total", "__count")
    return sums.select(*[F.col(f"`{k}`") for k in keys], (F.col("__total") / F.col("__count")).alias(value))
