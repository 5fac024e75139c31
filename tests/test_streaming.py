import json

from gaugeframe.streaming.intake import append_observations, read_intake, stream_landed
from test_facts import files_read


def land(folder, name, *codes):
    body = json.dumps({"value": [{"SpatialDim": "AFG", "TimeDim": 2000, "NumericValue": 1.5}]})
    lines = [json.dumps({"url": c, "code": c, "status": 200 if c != "BAD" else 500, "body": body}) for c in codes]
    (folder / name).write_text("\n".join(lines))


def test_pages_count_once_however_often_the_intake_runs(spark, rows, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def run():
        query = append_observations(stream_landed(spark, str(landing), 1), table, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
        return rows(spark.read.parquet(table), "IndicatorCode")

    land(landing, "1.json", "A", "BAD")
    land(landing, "2.json", "B")
    assert run() == [("A",), ("B",)]
    assert run() == [("A",), ("B",)]
    land(landing, "3.json", "C")
    assert run() == [("A",), ("B",), ("C",)]


def test_many_codes_make_few_files(spark, rows, tmp_path):
    """Files are bounded by the folders and their tasks, and look-ups read the folders of their codes."""
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    landing.mkdir()
    codes = [f"{i:03}" for i in range(400)]
    land(landing, "1.json", *codes)
    append_observations(stream_landed(spark, str(landing)), table, str(tmp_path / "checkpoint")).awaitTermination(120)
    files = len(list((tmp_path / "table").rglob("*.parquet")))
    assert files <= 256 < len(codes)
    stored = read_intake(spark, table)
    assert stored.columns == ["SpatialDim", "TimeDim", "NumericValue", "IndicatorCode"]
    assert rows(stored, "IndicatorCode") == [(c,) for c in codes]
    for size in (0, 1 << 25):
        some = read_intake(spark, table, spark.createDataFrame([("007",), ("007",), ("none",), (None,)], "IndicatorCode string"), broadcast_bytes=size)
        assert rows(some) == [("AFG", "2000", 1.5, "007")]
    assert files_read(read_intake(spark, table, spark.createDataFrame([("007",)], "IndicatorCode string"))) < files / 4
