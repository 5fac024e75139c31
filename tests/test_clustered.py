"""Clustered observations, and rows left out before a shuffle."""

import pytest
from pyspark.sql import functions as F

from gaugeframe.operators.bloom import keep_possible
from gaugeframe.operators.facts import observations_for
from gaugeframe.sources.clustered import clustered_without_data, read_clustered, stored_codes, write_clustered


def nodes(df):
    """All operators of the plan that ran, also those of finished stages."""
    # A plan of its own, since metrics add up over runs.
    plan = df.select(*[f"`{c}`" for c in df.columns])._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    queue, found = [plan], []
    while queue:
        node = queue.pop()
        found.append(node)
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            queue.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            queue.append(node.plan())
        queue += [node.children().apply(i) for i in range(node.children().size())]
    return found


def metric(df, kind, name):
    return [n.metrics().apply(name).value() for n in nodes(df) if n.getClass().getSimpleName() == kind and n.metrics().contains(name)]


@pytest.fixture(scope="module")
def facts(spark):
    """2,000 codes of 20 rows, one of 20,000, and rows without a code."""
    ids = spark.range(61_000)
    code = F.when(F.col("id") < 40_000, F.format_string("C%04d", F.col("id") % 2000)).when(F.col("id") < 60_000, "HOT")
    return ids.select(
        F.concat(F.lit("E"), F.col("id") % 37).alias("SpatialDim"),
        (2000 + F.col("id") % 11).cast("int").alias("TimeDim"),
        code.alias("IndicatorCode"),
        (F.col("id") / 8).alias("NumericValue"),
        F.col("id").cast("string").alias("Dim1"),
    )


@pytest.fixture(scope="module")
def path(facts, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clustered"))
    write_clustered(facts, folder, files=12, group_bytes=16_384, page_rows=200)
    return folder


def selection(spark, *codes):
    return spark.createDataFrame([(c, "n") for c in codes], "IndicatorCode string, IndicatorName string")


@pytest.mark.parametrize(
    "codes, most_files, most_rows",
    [(("C0007",), 2, 2500), (("C0007", "C1999", "absent"), 4, 6000), (("HOT",), 7, 26_000), (("absent",), 0, 0), ((None,), 0, 0)],
)
@pytest.mark.parametrize("dedupe", [False, True])
def test_little_is_read_for_a_selection(spark, facts, path, rows, codes, most_files, most_rows, dedupe):
    chosen = selection(spark, *codes, codes[0])
    found = read_clustered(spark, path, chosen, dedupe)
    want = observations_for(facts, chosen, dedupe).select(found.columns)
    assert rows(found) == rows(want)
    assert sum(metric(found, "FileSourceScanExec", "numFiles")) <= most_files
    assert sum(metric(found, "FileSourceScanExec", "numOutputRows")) <= most_rows


def test_row_groups_within_a_file(spark, facts, tmp_path):
    """All codes in one file: a code that is there, and one that only the Bloom filter rules out."""
    write_clustered(facts, str(tmp_path), files=1, group_bytes=8192, page_rows=100)
    found = read_clustered(spark, str(tmp_path), selection(spark, "C0100"))
    assert found.count() == 20 and sum(metric(found, "FileSourceScanExec", "numOutputRows")) < 4000
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(IndicatorCode,C0100)" in text
    entity = spark.read.parquet(f"{tmp_path}/rows").filter("SpatialDim = 'E5x'")
    assert sum(metric(entity, "FileSourceScanExec", "numOutputRows")) == 0


def test_large_selection_and_whole_table(spark, facts, path, rows):
    chosen = selection(spark, *[f"C{i:04}" for i in range(0, 2000, 7)])
    found = read_clustered(spark, path, chosen, broadcast_bytes=0)
    assert rows(found, "IndicatorCode", "Dim1") == rows(observations_for(facts, chosen), "IndicatorCode", "Dim1")
    assert read_clustered(spark, path).count() == 61_000


def test_codes_are_known_without_the_rows(spark, path, rows):
    held = dict(rows(stored_codes(spark, path)))
    assert len(held) == 2001 and held["HOT"] == 20_000 and held["C0001"] == 20
    chosen = selection(spark, "HOT", "absent")
    assert rows(clustered_without_data(spark, path, chosen), "IndicatorCode") == [("absent",)]


def test_no_observations(spark, facts, tmp_path):
    write_clustered(facts.limit(0), str(tmp_path))
    assert read_clustered(spark, str(tmp_path), selection(spark, "HOT")).count() == 0


def test_rows_of_other_keys_stay_behind(spark, facts, rows):
    keys = facts.filter("IndicatorCode < 'C0200'").select("IndicatorCode")
    near = keep_possible(facts, keys, "IndicatorCode")
    assert near.columns == facts.columns
    assert rows(near.filter("IndicatorCode < 'C0200'"), "Dim1") == rows(facts.filter("IndicatorCode < 'C0200'"), "Dim1")
    assert near.count() < 4000 + 0.04 * 57_000
    assert keep_possible(facts, keys.limit(0), "IndicatorCode").count() == 0
    assert keep_possible(facts, keys, "IndicatorCode", most_bytes=0) is facts


def test_only_bodies_of_selected_codes_are_shuffled(spark):
    """A selection too large to broadcast: what moves are its pages, and few others."""
    pages = spark.range(20_000).select(F.concat(F.lit("C"), F.col("id") % 5000).alias("code"), F.repeat(F.lit("x"), 200).alias("body"))
    chosen = selection(spark, *[f"C{i}" for i in range(0, 5000, 10)])
    for dedupe in (False, True):
        found = observations_for(pages, chosen, dedupe, broadcast_bytes=0, key="code")
        assert found.count() == 2000
        written = metric(found, "ShuffleExchangeExec", "shuffleRecordsWritten")
        assert max(written) < 2000 + 0.03 * 18_000, written
