"""Columns found from the data, and pages without rows."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from gaugeframe.operators.facts import NoDataError
from gaugeframe.plans.topics import Topic, run_landed_topic
from gaugeframe.schemas import LANDED
from gaugeframe.sources.inferred import infer_rows, union_widened, unreadable_entries, variant_rows
from gaugeframe.sources.landing import scan_observations


def landed(spark, *rows):
    return spark.createDataFrame([(u, c, s, b if b is None or isinstance(b, str) else json.dumps(b)) for u, c, s, b in rows], LANDED)


def page(*rows):
    return {"value": list(rows)}


ODD = {"a b": 1, "x'y": True, "back`tick": "t", "OBJECT": 2, "dot.ted": 3, "none": None, "nest": {"k": [1, "2"]}, "IndicatorCode": "payload", "code": "own"}


def test_types_are_widened_over_pages(spark):
    pages = landed(
        spark,
        ("1", "A", 200, page({"n": 1, "f": 1, "t": 1998, "b": True}, ODD)),
        ("2", "A", 200, page({"n": 2, "f": 2.5, "t": "1998a", "late": "x"}, None)),
        ("3", "B", 404, page({"lost": 1})),
        ("4", "B", 200, {"error": "busy"}),
        ("5", "B", 200, page()),
    )
    found = infer_rows(pages, required=("TimeDim", "n"))
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    numbers = {"n": "bigint", "a b": "bigint", "OBJECT": "bigint", "dot.ted": "bigint", "f": "double", "b": "boolean", "x'y": "boolean"}
    texts = dict.fromkeys(["t", "late", "code", "back`tick", "none", "nest", "TimeDim", "IndicatorCode"], "string")
    assert kinds == {**numbers, **texts}
    rows = {r["n"]: r for r in found.collect()}
    assert len(rows) == 3 and rows[1]["t"] == "1998" and rows[1]["f"] == 1.0 and rows[2]["t"] == "1998a"
    assert rows[None]["nest"] == '{"k":[1,"2"]}' and rows[None]["dot.ted"] == 3 and rows[None]["x'y"] is True
    assert {r["IndicatorCode"] for r in rows.values()} == {"A"} and rows[None]["code"] == "own"
    bare = infer_rows(landed(spark, ("1", "A", 200, page({}, {"IndicatorCode": "x"}))))
    assert [tuple(r) for r in bare.collect()] == [("A",), ("A",)]


def test_given_types_and_no_rows(spark):
    empty = infer_rows(landed(spark, ("1", "A", 200, page())), required=("SpatialDim",))
    assert empty.columns == ["IndicatorCode", "SpatialDim"] and empty.count() == 0
    types = T.StructType([T.StructField("n", T.LongType())])
    good = landed(spark, ("1", "A", 200, page({"n": 5, "m": 1})))
    assert [tuple(r) for r in infer_rows(good, types=types).collect()] == [("A", 5)]
    with pytest.raises((PySparkException, Py4JJavaError)):
        infer_rows(landed(spark, ("1", "A", 200, page({"n": "five"}))), types=types).collect()


def test_what_cannot_be_read_is_named_or_stops(spark, rows):
    bad = [("html", "<x>", "not a page"), ("list", "[1]", "not a page"), ("error", {"error": 1}, "no rows"), ("scalars", {"value": [1]}, "row is not an object")]
    pages = landed(spark, ("good", "A", 200, page({"n": 1})), *[(u, "A", 200, b) for u, b, _ in bad])
    assert rows(unreadable_entries(pages)) == sorted((u, "A", p) for u, _, p in bad)
    for url, body, problem in bad:
        one = landed(spark, (url, "A", 200, body))
        if problem == "no rows":
            assert variant_rows(one).count() == 0
        with pytest.raises((PySparkException, Py4JJavaError), match=problem):
            variant_rows(one, on_missing="fail").collect()


def test_union_of_different_types(spark):
    frames = [spark.sql("SELECT 1 AS a, 'x' AS b, NULL AS c"), spark.sql("SELECT 2.5D AS a, 7 AS b, 3 AS c, true AS `d.e`")]
    found = union_widened(frames)
    assert [f.dataType.simpleString() for f in found.schema] == ["double", "string", "int", "boolean"]
    assert {tuple(r) for r in found.collect()} == {(1.0, "x", None, None), (2.5, "7", 3, True)}
    with pytest.raises(NoDataError):
        union_widened([])


def test_pages_without_rows_by_topic(spark):
    catalog = landed(spark, ("c", None, 200, page({"IndicatorCode": "A", "IndicatorName": "red one"})), ("d", None, 200, {"note": "end"}))
    facts = landed(
        spark,
        ("1", "A", 200, page({"SpatialDim": "AND", "TimeDim": 2000, "NumericValue": 3})),
        ("2", "A", 200, {"error": "busy"}),
    )
    assert run_landed_topic(catalog, facts, Topic("red")).long.count() == 1
    with pytest.raises((PySparkException, Py4JJavaError), match="no rows"):
        run_landed_topic(catalog, facts, Topic("red", on_missing="fail")).long.collect()
    flagged = scan_observations(facts.withColumn("strict", facts["url"] == "1"), on_missing=facts["url"] == "1")
    assert flagged.count() == 1
