import pytest
from pyspark.sql import functions as F

from gaugeframe.operators.facts import (
    NoDataError,
    ensure_not_empty,
    indicators_without_data,
    observations_for,
    union_all,
)
from gaugeframe.operators.joins import join_on_key, measured_bytes
from gaugeframe.operators.selection import select_indicators
from gaugeframe.plans.topics import Topic, run_topic
from gaugeframe.schemas import CATALOG
from gaugeframe.sources.observations import read_observations, write_observations


@pytest.fixture
def selection(spark):
    return spark.createDataFrame([("A", "one"), ("A", "two"), ("B", "bee"), ("Z", "empty"), (None, "null")], CATALOG)


@pytest.fixture
def facts(spark):
    rows = [("A", i) for i in range(4)] + [("B", 9), ("B", 9), ("C", 1), (None, 5)]
    return spark.createDataFrame(rows, "IndicatorCode string, NumericValue int")


WAYS = [{}, {"broadcast_bytes": 0}]


@pytest.mark.parametrize("way", WAYS)
def test_two_names_collect_twice(selection, facts, rows, way):
    found = observations_for(facts, selection, **way)
    expected = sorted([("A", i) for i in range(4)] * 2 + [("B", 9)] * 2)
    assert rows(found, "IndicatorCode", "NumericValue") == expected


@pytest.mark.parametrize("way", WAYS)
def test_codes_once(selection, facts, rows, way):
    found = observations_for(facts, selection, dedupe=True, **way)
    assert rows(found, "IndicatorCode", "NumericValue") == [("A", i) for i in range(4)] + [("B", 9)] * 2


@pytest.mark.parametrize("way", WAYS)
def test_indicators_without_data(selection, facts, rows, way):
    found = indicators_without_data(selection, facts, **way)
    assert rows(found, "IndicatorCode", "IndicatorName") == [(None, "null"), ("Z", "empty")]


def test_hot_key_is_split_and_nothing_is_lost(spark):
    facts = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("k"), "id"
    )
    lookup = spark.range(900).select(F.col("id").cast("string").alias("k")).union(spark.createDataFrame([("hot",)], "k string"))
    plain = facts.join(lookup, "k")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for how in ("inner", "left_semi"):
            joined = join_on_key(facts, lookup, "k", how, broadcast_bytes=0)
            assert joined.count() == plain.count() and joined.exceptAll(plain).count() == 0
            joined.collect()
            text = joined._jdf.queryExecution().executedPlan().toString()
            final = text.split("== Initial Plan ==")[0]
            assert "SortMergeJoin(skew=true)" in final and final.count("Range (0, 300000") == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_measured_size_decides_on_broadcasting(spark, facts, selection):
    codes = selection.select("IndicatorCode").distinct()
    assert measured_bytes(codes) < measured_bytes(selection) < 1000
    assert measured_bytes(codes.limit(0)) == 0
    plan = join_on_key(facts, codes, "IndicatorCode")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    with pytest.raises(ValueError):
        join_on_key(facts, codes, "IndicatorCode", "outer")


def test_stored_observations_are_pruned_by_code(spark, rows, tmp_path):
    facts = spark.range(600).select(
        F.lit("AFG").alias("SpatialDim"), (F.col("id") % 12).cast("string").alias("IndicatorCode"), F.col("id").alias("NumericValue")
    )
    write_observations(facts, str(tmp_path / "facts"))
    stored = read_observations(spark, str(tmp_path / "facts"))
    assert dict(stored.dtypes)["IndicatorCode"] == "string"
    catalog = spark.createDataFrame([(str(i), f"name {i % 4}") for i in range(12)], CATALOG)
    for terms in (["3"], ["3", "no such"]):
        for dedupe in (False, True):
            found = observations_for(stored, select_indicators(catalog, terms), dedupe)
            assert rows(found.groupBy("IndicatorCode").count()) == [("11", 50), ("3", 50), ("7", 50)]
            assert files_read(found) == 3
    topic = Topic("threes", ("3",))
    assert files_read(run_topic(catalog, stored.withColumn("TimeDim", F.lit(2000)), topic).long) == 3


def files_read(df):
    """Files that the scan of the facts really read."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    text = plan.toString()
    assert "dynamicpruning" in text.lower()
    return plan_metric(plan, "numFiles")


def plan_metric(plan, name):
    nodes, total = [plan], 0
    while nodes:
        node = nodes.pop()
        children = [c for c in (node.children().apply(i) for i in range(node.children().size()))]
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            children.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            children.append(node.plan())
        nodes += children
        if node.getClass().getSimpleName() == "FileSourceScanExec" and node.metrics().contains(name):
            total += node.metrics().apply(name).value()
    return total


def test_codes_with_leading_zeros_stay_text(spark, rows, tmp_path):
    facts = spark.createDataFrame([("007", 1.0), ("7", 2.0)], "IndicatorCode string, NumericValue double")
    write_observations(facts, str(tmp_path / "facts"))
    stored = read_observations(spark, str(tmp_path / "facts"))
    assert rows(stored, "IndicatorCode", "NumericValue") == [("007", 1.0), ("7", 2.0)]


def test_union_by_name_keeps_copies(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, n int")
    assert rows(union_all([a, b, b]), "n", "a", "b") == [(1, "x", None), (2, None, "y"), (2, None, "y")]
    with pytest.raises(NoDataError):
        union_all([])


def test_empty_input_is_refused(facts):
    assert ensure_not_empty(facts) is facts
    with pytest.raises(NoDataError, match="nothing here"):
        ensure_not_empty(facts.filter("NumericValue > 100"), "nothing here")


@pytest.mark.parametrize("dedupe", [False, True])
def test_rows_of_a_large_selection_are_not_sorted(spark, rows, dedupe):
    """The memory of a task does not grow with the rows of one code; a code is split all the same."""
    facts = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("IndicatorCode"), "id"
    )
    chosen = spark.range(600).select(F.col("id").cast("string").alias("IndicatorCode"))
    chosen = chosen.union(spark.createDataFrame([("hot",), ("hot",), (None,)], "IndicatorCode string"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = observations_for(facts, chosen, dedupe, broadcast_bytes=0)
        plain = facts.join(chosen.distinct() if dedupe else chosen, "IndicatorCode")
        assert rows(found.groupBy("IndicatorCode").count()) == rows(plain.groupBy("IndicatorCode").count())
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ShuffledHashJoin(skew=true)" in final and "Sort [" not in final
    finally:
        for k in settings:
            spark.conf.unset(k)
