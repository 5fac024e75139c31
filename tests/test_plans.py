"""What the optimizer makes of the operators: pruned scans, no needless shuffles or joins."""

import pytest
from pyspark.sql import functions as F

from gaugeframe.operators.facts import observations_for
from gaugeframe.operators.reshape import clean_long, mean_cells, pivot_wide
from gaugeframe.operators.selection import select_by_topic, select_indicators
from gaugeframe.plans.topics import TOPICS, all_topics_cells, all_topics_rows
from gaugeframe.sinks.csv import wide_csv_lines
from gaugeframe.storage import cut_lineage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, column):
    return [line for line in plan(df).splitlines() if "FileScan" in line and column in line]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    ids = spark.range(5000)
    ids.select(
        F.concat(F.lit("E"), F.col("id") % 50).alias("SpatialDim"),
        (F.lit(2000) + F.col("id") % 9).cast("int").alias("TimeDim"),
        F.concat(F.lit("C"), F.col("id") % 300).alias("IndicatorCode"),
        (F.col("id") / 4).alias("NumericValue"),
        F.lit("x").alias("Dim1"),
        F.lit("y").alias("Comments"),
    ).write.parquet(path + "/facts")
    ids.filter("id < 300").select(
        F.concat(F.lit("C"), "id").alias("IndicatorCode"),
        F.when(F.col("id") % 3 == 0, "Malaria deaths").otherwise("Other").alias("IndicatorName"),
        F.lit("EN").alias("Language"),
    ).write.parquet(path + "/catalog")
    return spark.read.parquet(path + "/catalog"), spark.read.parquet(path + "/facts")


def test_scans_read_the_needed_columns_and_push_key_checks(stored):
    catalog, facts = stored
    (scan,) = scans(mean_cells(clean_long(facts)), "NumericValue")
    assert "Dim1" not in scan and "Comments" not in scan
    (scan,) = scans(select_indicators(catalog, ["malaria"]), "IndicatorName")
    assert "Language" not in scan


def test_whole_years_need_no_check_so_filters_reach_the_scan(stored):
    _, facts = stored
    (scan,) = scans(clean_long(facts).filter("YEAR = 2003 and COUNTRY = 'E1'"), "NumericValue")
    assert "EqualTo(TimeDim,2003)" in scan and "EqualTo(SpatialDim,E1)" in scan


def test_a_small_selection_is_broadcast_and_the_facts_are_not_shuffled(stored):
    catalog, facts = stored
    chosen = clean_long(observations_for(facts, select_indicators(catalog, ["malaria"])))
    text = plan(chosen)
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text  # the distinct selection is stored before


def test_topics_are_matched_without_a_join(stored):
    catalog, _ = stored
    text = plan(select_by_topic(catalog, {t.name: t.patterns for t in TOPICS}))
    assert "Join" not in text and text.count("FileScan") == 1


def test_many_topics_scan_the_facts_once(stored):
    catalog, facts = stored
    for df in (all_topics_rows(catalog, facts), all_topics_cells(catalog, facts)):
        assert len(scans(df, "NumericValue")) == 1


def test_means_are_partly_made_before_the_only_shuffle(stored):
    _, facts = stored
    text = plan(mean_cells(clean_long(facts)))
    assert text.count("Exchange ") == 1
    assert "partial_avg" in text[text.index("Exchange ") :]


def test_known_keys_reach_the_scan(stored):
    _, facts = stored
    wide = pivot_wide(mean_cells(clean_long(facts)), keys=[("C1", 2001), ("C2", 2001)])
    (scan,) = scans(wide, "NumericValue")
    assert "In(IndicatorCode, [C1,C2])" in scan and "EqualTo(TimeDim,2001)" in scan


def test_wide_lines_take_one_shuffle_of_the_means(stored):
    _, facts = stored
    cells = cut_lineage(mean_cells(clean_long(facts)))
    text = plan(wide_csv_lines(cells, [("C1", 2001), ("C2", 2002)]))
    assert text.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in text
