"""Sparse wide rows: read back, sliced, and wider than a schema."""

import pytest
from pyspark.sql import functions as F

from gaugeframe.operators.reshape import mean_cells, pivot_wide
from gaugeframe.operators.sparse import sparse_cells, sparse_columns, sparse_rows, sparse_slice, write_sparse

LONG = "COUNTRY string, YEAR int, IndicatorCode string, NumericValue double"
NAMES = ("COUNTRY", "IndicatorCode", "YEAR", "NumericValue")


@pytest.fixture(scope="module")
def cells(spark):
    ids = spark.range(3000)
    return ids.select(
        F.format_string("E%02d", F.col("id") % 41).alias("COUNTRY"), (2000 + F.col("id") % 13).cast("int").alias("YEAR"),
        F.concat(F.lit("C|"), F.col("id") % 29).alias("IndicatorCode"), (F.col("id") / 7).alias("NumericValue"),
    ).dropDuplicates(["COUNTRY", "YEAR", "IndicatorCode"])


@pytest.mark.parametrize("block", [1, 10, 4096])
def test_cells_are_read_back(spark, rows, cells, tmp_path, block):
    write_sparse(cells, str(tmp_path), block=block)
    assert rows(sparse_cells(spark, str(tmp_path)), *NAMES) == rows(cells, *NAMES)
    for r in sparse_rows(spark, str(tmp_path)).collect():
        assert r["places"] == sorted(set(r["places"])) and len(r["places"]) == len(r["values"]) <= block
    wide = pivot_wide(cells)
    for first, count in ((0, 5), (7, 9), (370, 100), (0, 377)):
        found = sparse_slice(spark, str(tmp_path), first, count)
        names = wide.columns[1:][first : first + count]
        assert found.columns[1:] == names
        want = wide.select("COUNTRY", *[f"`{n}`" for n in names]).dropna(how="all", subset=[f"`{n}`" for n in names])
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in want.orderBy("COUNTRY").collect()]
    assert sparse_slice(spark, str(tmp_path), 1000, 5).count() == 0


def test_a_slice_reads_its_blocks_only(spark, cells, tmp_path):
    write_sparse(cells, str(tmp_path), block=100)
    plan = sparse_slice(spark, str(tmp_path), 120, 20)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "Exchange hashpartitioning" not in plan


def test_wider_than_a_schema(spark, tmp_path):
    long = spark.range(150_000).select(
        F.lit("AFG").alias("COUNTRY"), F.lit(2000).alias("YEAR"), F.format_string("C%06d", "id").alias("IndicatorCode"), (F.col("id") / 2).alias("NumericValue")
    )
    write_sparse(mean_cells(long), str(tmp_path))
    assert sparse_columns(spark, str(tmp_path)).count() == sparse_cells(spark, str(tmp_path)).count() == 150_000
    (row,) = sparse_slice(spark, str(tmp_path), 99_999, 3).collect()
    assert row.asDict() == {"COUNTRY": "AFG", "C099999|2000": 49999.5, "C100000|2000": 50000.0, "C100001|2000": 50000.5}


def test_no_cells_and_missing_keys(spark, rows, tmp_path):
    some = spark.createDataFrame([("A", 2000, "X", 1.0), (None, 2000, "X", 2.0), ("B", None, "X", 3.0), ("C", 2000, "X", None)], LONG)
    write_sparse(some, str(tmp_path / "a"))
    assert rows(sparse_cells(spark, str(tmp_path / "a")), *NAMES) == [("A", "X", 2000, 1.0), ("C", "X", 2000, None)]
    write_sparse(some.limit(0), str(tmp_path / "b"))
    assert sparse_cells(spark, str(tmp_path / "b")).count() == 0
