from pyspark.sql import functions as F

from gaugeframe.storage import checkpoint_root, cut_lineage, scratch_path


def test_the_session_names_the_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == named
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(named)


def test_stored_frames_start_anew(spark):
    stored = cut_lineage(spark.range(10).filter(F.col("id") > 3))
    assert stored.count() == 6
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
