"""Pages landed more than once: the last one in batch, the first accepted one in the stream."""

import pytest
from pyspark.sql import functions as F

from gaugeframe.schemas import LANDED
from gaugeframe.sources.landing import latest_pages, read_landed
from gaugeframe.sources.observations import read_observations
from gaugeframe.streaming.intake import append_observations, stream_landed

PAGE = '{"value": [{"SpatialDim": "%s", "TimeDim": 2000, "NumericValue": 1}]}'


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 25])
def test_the_last_page_of_an_address(spark, rows, broadcast_bytes):
    pages = [
        ("a", "A", 200, "old", 1), ("a", "A", 200, "new", 2), ("b", "A", 200, "good", 1), ("b", "A", 500, "late failure", 9),
        ("c", "A", 200, "only", None), ("d", "A", 404, "x", 1), ("d", "A", None, "y", 2), ("e", "A", 200, "same", 3), ("e", "A", 200, "same", 3),
        (None, "A", 200, "n1", 1), (None, "A", 200, "n1", 1), ("f", None, 200, None, None), ("f", None, 200, "b", 1),
    ]
    landed = spark.createDataFrame(pages, "url string, code string, status int, body string, seen int")
    found = rows(latest_pages(landed, "seen", broadcast_bytes), "url", "body")
    assert found == [(None, "n1"), (None, "n1"), ("a", "new"), ("b", "good"), ("c", "only"), ("d", "y"), ("e", "same"), ("f", "b")]
    assert latest_pages(landed.limit(0), "seen").count() == 0


def test_files_tell_the_time(spark, tmp_path):
    pages = spark.createDataFrame([("a", "A", 200, "x")], LANDED)
    pages.write.json(str(tmp_path / "pages"))
    landed = read_landed(spark, str(tmp_path / "pages"), fetched="fetched")
    assert latest_pages(landed, "fetched").columns == ["url", "code", "status", "body", "fetched"]


@pytest.mark.parametrize("once, count", [(True, 4), (False, 5)])
def test_an_address_is_taken_in_once(spark, rows, tmp_path, once, count):
    runs = [
        [("a", "A", 200, PAGE % "first"), ("b", "A", 500, "down"), (None, "B", 200, PAGE % "n1")],
        [("a", "A", 200, PAGE % "again"), ("b", "A", 200, PAGE % "later"), (None, "B", 200, PAGE % "n2")],
    ]
    for pages in runs:
        spark.createDataFrame(pages, LANDED).coalesce(1).write.mode("append").json(str(tmp_path / "landing"))
        landed = stream_landed(spark, str(tmp_path / "landing"))
        append_observations(landed, str(tmp_path / "table"), str(tmp_path / "progress"), once=once).awaitTermination()
    table = read_observations(spark, str(tmp_path / "table"))
    assert rows(table, "SpatialDim") == sorted([(x,) for x in ["first", "later", "n1", "n2"] + ["again"] * (not once)])
    assert table.count() == count


def test_a_large_code_is_written_by_several_tasks(spark, tmp_path):
    spark.range(400).select(
        F.col("id").cast("string").alias("url"), F.lit("HOT").alias("code"), F.lit(200).alias("status"), F.format_string(PAGE, "id").alias("body")
    ).write.json(str(tmp_path / "landing"))
    landed = stream_landed(spark, str(tmp_path / "landing"))
    append_observations(landed, str(tmp_path / "table"), str(tmp_path / "progress"), tasks_per_code=40).awaitTermination()
    assert len(list((tmp_path / "table" / "IndicatorCode=HOT").glob("*.parquet"))) > 1
    assert read_observations(spark, str(tmp_path / "table")).count() == 400
