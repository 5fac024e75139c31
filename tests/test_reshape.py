import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeframe.functions.numbers import float_text, nan_to_null, whole_year
from gaugeframe.operators.reshape import (
    TooManyColumnsError,
    clean_long,
    column_dictionary,
    mean_cells,
    pivot_wide,
    unpivot_wide,
    wide_keys,
)
from gaugeframe.schemas import MissingColumnsError

RAW = "SpatialDim string, TimeDim int, IndicatorCode string, NumericValue double, Dim1 string"
LONG = "COUNTRY string, YEAR int, IndicatorCode string, NumericValue double"


def raw(spark, *rows, schema=RAW):
    return spark.createDataFrame([(*r, "MALE") for r in rows], schema)


def test_missing_columns_are_all_named(spark):
    df = spark.createDataFrame([("A", 1)], "IndicatorCode string, Other int")
    with pytest.raises(MissingColumnsError, match="SpatialDim.*TimeDim.*NumericValue"):
        clean_long(df)


def test_rows_lacking_a_key_go_and_rows_lacking_a_value_stay(spark, rows):
    df = raw(
        spark,
        (None, 2000, "A", 1.0),
        ("AFG", None, "A", 1.0),
        ("AFG", 2000, None, 1.0),
        ("AFG", 2000, "A", None),
        ("AFG", 2001, "A", float("nan")),
        ("AFG", 2001, "A", 3.0),
        ("AFG", 2001, "A", 3.0),
    )
    long = clean_long(df, "COUNTRY/REGION")
    assert long.columns == ["COUNTRY/REGION", "YEAR", "IndicatorCode", "NumericValue"]
    assert rows(long) == [
        ("AFG", 2000, "A", None),
        ("AFG", 2001, "A", None),
        ("AFG", 2001, "A", 3.0),
        ("AFG", 2001, "A", 3.0),
    ]


def test_value_policy_keeps_rows_without_entity(spark, rows):
    df = raw(spark, (None, 2000, "A", 1.0), ("AFR", 2000, "A", None), ("AFR", 2000, "A", float("nan")))
    long = clean_long(df, "REGION", null_policy="value")
    assert rows(long) == [(None, 2000, "A", 1.0)]
    assert mean_cells(long, "REGION").count() == 0


def test_value_policy_refuses_a_missing_year(spark):
    df = raw(spark, ("AFR", None, "A", 1.0))
    with pytest.raises(PySparkException, match="without a year"):
        clean_long(df, null_policy="value").collect()
    with pytest.raises(PySparkException, match="without a year"):
        mean_cells(clean_long(df, null_policy="value")).collect()
    with pytest.raises(ValueError):
        clean_long(df, null_policy="other")


def test_fractional_years_are_cut_and_text_years_checked(spark, rows):
    fractional = raw(
        spark, ("AFG", 2016.7, "A", 1.0), ("AFG", float("nan"), "A", 2.0), schema=RAW.replace("TimeDim int", "TimeDim double")
    )
    assert rows(clean_long(fractional)) == [("AFG", 2016, "A", 1.0)]
    text = RAW.replace("TimeDim int", "TimeDim string")
    assert rows(clean_long(raw(spark, ("AFG", "2016", "A", 1.0), schema=text)), "YEAR") == [(2016,)]
    for bad in ("2016.0", "2000-2005"):
        df = raw(spark, ("AFG", bad, "A", 1.0), schema=text)
        with pytest.raises(PySparkException, match="not a year"):
            clean_long(df).collect()
        assert rows(clean_long(df, lenient_year=True), "YEAR") == [(None,)]


def test_year_check_does_not_depend_on_the_ansi_setting(spark):
    df = spark.createDataFrame([("x",)], "y string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="not a year"):
            df.select(whole_year(F.col("y"))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_means_skip_missing_values_and_drop_empty_groups(spark, rows):
    long = spark.createDataFrame(
        [
            ("AFG", 2000, "A", 1.0),
            ("AFG", 2000, "A", 2.0),
            ("AFG", 2000, "A", None),
            ("AFG", 2000, "A", float("nan")),
            ("ALB", 2000, "A", None),
            ("AFG", 2001, "B", None),
        ],
        LONG,
    )
    assert rows(mean_cells(long)) == [("AFG", "A", 2000, 1.5)]
    assert rows(mean_cells(long, scale=2)) == [("AFG", "A", 2000, 1.5)]


def test_scaled_means_do_not_depend_on_the_order(spark):
    values = [("AFG", 2000, "A", v / 100) for v in range(1, 4000, 7)]
    means = {
        mean_cells(spark.createDataFrame(v, LONG).repartition(n), scale=2).first()["NumericValue"]
        for v, n in ((values, 1), (values[::-1], 3), (values, 4))
    }
    assert means == {sum(range(1, 4000, 7)) / 100 / len(values)}


def test_wide_table_is_ordered_and_leaves_absent_cells_empty(spark):
    long = spark.createDataFrame(
        [("ZWE", 2000, "B", 4.0), ("AFG", 2010, "A", 1.0), ("AFG", 2009, "A", 2.0), ("ALB", 2000, "B", None), ("AFG", 2010, "A", 2.0)],
        LONG,
    )
    wide = pivot_wide(mean_cells(long))
    assert wide.columns == ["COUNTRY", "A|2009", "A|2010", "B|2000"]
    assert [tuple(r) for r in wide.collect()] == [("AFG", 2.0, 1.5, None), ("ZWE", None, None, 4.0)]


def test_known_keys_give_a_stable_schema(spark):
    cells = mean_cells(spark.createDataFrame([("AFG", 2000, "A", 1.0), ("ALB", 2000, "X", 1.0)], LONG))
    wide = pivot_wide(cells, keys=[("A", 2000), ("A", 2001)])
    assert [tuple(r) for r in wide.collect()] == [("AFG", 1.0, None)]
    with pytest.raises(ValueError):
        pivot_wide(cells, keys=[])


def test_known_keys_that_are_not_all_combinations(spark):
    rows = [("AFG", 2000, "A", 1.0), ("AFG", 2001, "B", 2.0), ("ALB", 2001, "A", 9.0), ("ZWE", 2000, "B", 9.0)]
    wide = pivot_wide(mean_cells(spark.createDataFrame(rows, LONG)), keys=[("A", 2000), ("B", 2001)])
    assert [tuple(r) for r in wide.collect()] == [("AFG", 1.0, 2.0)]


def test_no_values_give_an_empty_wide_table(spark):
    wide = pivot_wide(mean_cells(spark.createDataFrame([("AFG", 2000, "A", None)], LONG)))
    assert wide.columns == ["COUNTRY"] and wide.count() == 0


def test_too_many_columns_are_refused_not_cut(spark):
    cells = mean_cells(spark.createDataFrame([("AFG", y, "A", 1.0) for y in range(2000, 2006)], LONG))
    assert len(wide_keys(cells, 6)) == 6
    with pytest.raises(TooManyColumnsError):
        pivot_wide(cells, max_columns=5)


def test_codes_may_hold_the_separator(spark, rows):
    cells = mean_cells(spark.createDataFrame([("AFG", 2000, "A|1999", 1.0), ("AFG", 1999, "A", 2.0)], LONG))
    assert wide_keys(cells) == [("A", 1999), ("A|1999", 2000)]
    assert rows(pivot_wide(cells)) == [("AFG", 2.0, 1.0)]


def test_column_dictionary_numbers_the_columns(spark, rows):
    cells = mean_cells(
        spark.createDataFrame([("AFG", 2001, "B", 1.0), ("AFG", 2000, "B", 1.0), ("ALB", 2005, "A", 1.0)], LONG)
    )
    assert rows(column_dictionary(cells), "ordinal", "IndicatorCode", "YEAR") == [(0, "A", 2005), (1, "B", 2000), (2, "B", 2001)]


def test_pivot_needs_two_exchanges(spark):
    """One for the means and one for entities, which also gives the row order."""
    long = spark.createDataFrame([("AFG", 2000, "A", 1.0)], LONG)
    wide = pivot_wide(mean_cells(long), keys=[("A", 2000)])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["AFG", "ALB", "O'X|, \""]),
            st.integers(1999, 2001),
            st.sampled_from(["A", "B b"]),
            st.one_of(st.none(), st.integers(-50, 50).map(float)),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_unpivoting_the_wide_table_gives_the_means_back(spark, data):
    groups = {}
    for entity, year, code, value in data:
        if value is not None:
            groups.setdefault((entity, code, year), []).append(value)
    expected = {k: sum(v) / len(v) for k, v in groups.items()}
    cells = mean_cells(spark.createDataFrame(data, LONG))
    assert {tuple(r)[:3]: r[3] for r in cells.collect()} == pytest.approx(expected)
    if expected:
        keys = sorted({k[1:] for k in expected})
        back = unpivot_wide(pivot_wide(cells, keys=keys), "COUNTRY", keys)
        assert {tuple(r)[:3]: r[3] for r in back.collect()} == pytest.approx(expected)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(nan_to_null(F.col("v"))).collect()] == [None, 1.0, None]


def test_float_text_is_the_shortest_positional_text(spark):
    values = [0.0, 1.0, -2.5, 1e7, 12345678.9, 4.666666666666667, 20.000002000000002, 1e15, 123456789012345.6]
    values += [1e16, 1.5e20, 1e100, 1e-4, 0.00012345678901234567, 1e-5, -1.25e-7, 1e-300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [tuple(r) for r in df.select("v", float_text(F.col("v"))).collect()]
    assert found == [(v, repr(v)) for v in values]
    special = spark.createDataFrame([(math.inf,), (-math.inf,), (math.nan,), (None,)], "v double")
    assert [r[0] for r in special.select(float_text(F.col("v"))).collect()] == ["inf", "-inf", None, None]
