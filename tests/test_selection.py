import pytest
from pyspark.sql import functions as F

from gaugeframe.operators.profile import preview, row_count, shape
from gaugeframe.operators.selection import (
    number_selection,
    select_by_topic,
    select_indicators,
    selection_order,
    with_ordinal,
)
from gaugeframe.schemas import CATALOG, MissingColumnsError


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(
        [
            ("B2", "HIV prevalence"),
            ("A1", "hiv deaths"),
            ("A1", "hiv deaths"),
            ("A1", "Deaths by HIV"),
            (None, "HIV unknown"),
            ("C3", None),
            ("D4", "Malaria"),
            (None, "HIV unknown"),
        ],
        CATALOG,
    )


def test_selection_is_distinct_over_pairs(catalog, rows):
    expected = [(None, "HIV unknown"), ("A1", "Deaths by HIV"), ("A1", "hiv deaths"), ("B2", "HIV prevalence")]
    assert rows(select_indicators(catalog, ["HIV"])) == expected


def test_numbering_puts_missing_codes_last(catalog):
    numbered = number_selection(select_indicators(catalog, ["hiv"])).orderBy("ordinal")
    assert [tuple(r) for r in numbered.collect()] == [
        ("A1", "Deaths by HIV", 0),
        ("A1", "hiv deaths", 1),
        ("B2", "HIV prevalence", 2),
        (None, "HIV unknown", 3),
    ]


def test_numbering_runs_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    numbered = with_ordinal(df.repartition(5), [F.col("k").asc()])
    assert numbered.filter("k <> ordinal").count() == 0
    assert numbered.count() == 5000
    assert with_ordinal(df.limit(0), [F.col("k").asc()]).count() == 0


def test_positions_keep_the_first_place(spark, rows):
    placed = spark.createDataFrame(
        [("A", "x", 4), ("A", "x", 2), ("B", "xy", 3), ("C", "z", 0)],
        "IndicatorCode string, IndicatorName string, index long",
    )
    assert rows(select_indicators(placed, ["x"], position="index")) == [("A", "x", 2), ("B", "xy", 3)]


def test_topics_share_indicators(catalog, rows):
    found = select_by_topic(catalog, {"hiv": ("HIV",), "deaths": ("deaths", "malaria")})
    assert rows(found.groupBy("topic").count()) == [("deaths", 3), ("hiv", 4)]


def test_missing_catalog_columns(spark):
    with pytest.raises(MissingColumnsError, match="IndicatorName"):
        select_indicators(spark.createDataFrame([("A",)], "IndicatorCode string"), ["x"])


def test_profile(catalog, rows):
    assert rows(row_count(catalog)) == [(8,)]
    assert rows(shape(catalog)) == [(8, 2)]
    first = preview(catalog.dropDuplicates(), selection_order(), 3).collect()
    assert [r[0] for r in first] == ["A1", "A1", "B2"]
    assert preview(catalog, selection_order()).count() == 5
