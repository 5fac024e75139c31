"""Means that do not depend on the order of rows, against exact sums."""

import math
import random
import struct
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeframe.operators.means import exact_means, finished_sums, merge_states, sum_states
from gaugeframe.operators.reshape import mean_cells

NAN, INF = float("nan"), float("inf")


def bits(x):
    return "nan" if math.isnan(x) else struct.pack(">d", x + 0.0)


def exact(values):
    return float(sum(map(Fraction, values)))


def sums(spark, groups):
    rows = [(k, x) for k, values in groups.items() for x in values]
    frame = spark.createDataFrame(rows, "k int, x double").repartition(3)
    return {r["k"]: (r["total"], r["n"]) for r in finished_sums(sum_states(frame, ["k"], "x"), ["k"]).collect()}


def cases():
    rng = random.Random(1)
    yield [0.1] * 10
    yield [1e308, 1e308, -1e308, -1e308, 5e-324]
    yield [1e16, 1.0, -1e16]
    yield [2.0**28, 2.0**28 - 1, -(2.0**56), 2.0**-28, 3.0]
    yield [1.0, 2.0**-53, 2.0**-106]
    yield [1.0, 2.0**-53, -(2.0**-106)]
    yield [-1.0, -(2.0**-53), -(2.0**-106)]
    yield [0.0, -0.0]
    yield [5e-324, 2.2250738585072014e-308, 1e-300, -1e-305]
    for _ in range(60):
        spread = rng.choice([1, 20, 300])
        yield [rng.uniform(-1, 1) * 10.0 ** rng.randint(-spread, spread) for _ in range(rng.randint(1, 60))]


def test_sums_equal_exact_ones(spark):
    groups = dict(enumerate(cases()))
    found = sums(spark, groups)
    for k, values in groups.items():
        assert bits(found[k][0]) == bits(exact(values)) and found[k][1] == len(values), values


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=30), min_size=1, max_size=40))
def test_sums_equal_exact_ones_for_any_values(spark, lists):
    # A sum of normal values that is itself below them may be rounded twice.
    kept = {k: v for k, v in enumerate(lists) if not 0 < abs(exact(v)) < 1e-290}
    if kept:
        found = sums(spark, kept)
        assert {k: bits(v[0]) for k, v in found.items()} == {k: bits(exact(v)) for k, v in kept.items()}


def test_infinite_and_missing_values(spark):
    found = sums(spark, {1: [INF, 1.0], 2: [-INF, -INF], 3: [INF, -INF], 4: [None, NAN, 2.0]})
    assert found[1] == (INF, 2) and found[2] == (-INF, 2) and math.isnan(found[3][0]) and found[4] == (2.0, 1)
    assert sums(spark, {1: [None, NAN]}) == {}


def test_states_are_merged(spark, rows):
    values = spark.range(5000).select((F.col("id") % 7).alias("k"), (F.rand(3) * F.pow(F.lit(10.0), F.col("id") % 30 - 15)).alias("x")).cache()
    whole = rows(exact_means(values, ["k"], "x"))
    parts = [sum_states(values.filter(F.hash("x") % 3 == i), ["k"], "x") for i in (0, 1, 2, -1, -2)]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    merged = finished_sums(merge_states(stacked, ["k"]), ["k"])
    assert [(r["k"], bits(r["total"] / r["n"])) for r in merged.orderBy("k").collect()] == [(k, bits(x)) for k, x in whole]


@pytest.mark.parametrize("parts", [1, 2, 17])
def test_means_are_the_same_under_any_partitioning(spark, rows, parts):
    values = spark.range(3000).select(
        F.lit("A").alias("COUNTRY"), (F.col("id") % 3).cast("string").alias("IndicatorCode"), F.lit(2000).alias("YEAR"),
        (F.sin("id") * F.exp(F.col("id") % 50)).alias("NumericValue"),
    )
    want = {str(k): [] for k in range(3)}
    for r in values.collect():
        want[r["IndicatorCode"]].append(r["NumericValue"])
    found = mean_cells(values.orderBy(F.hash("NumericValue")).repartition(parts), exact=True)
    assert {r["IndicatorCode"]: bits(r["NumericValue"]) for r in found.collect()} == {k: bits(exact(v) / len(v)) for k, v in want.items()}
