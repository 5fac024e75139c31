"""All queries on odd tables and on the smallest data, and the pipeline stage by stage."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare
from gaugeframe.llm import disclosure, jaccard, maglev, mincut, paragraphs, repetition, secrets, tiling, toxicity
from gaugeframe.llm.queries import QUERIES, SHARDS, mix
from gaugeframe.llm.sql import ORACLE

DATA = Path("/root/testdata/sf0.001")
data = pytest.mark.skipif(not DATA.exists(), reason="no test data")

# Names that the operators use for columns of their own.
CLASHING = "id body row key tile tiles rep n sum_a keys component node low score place bucket slot found spans mix_epoch"
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING.split())


@pytest.fixture
def odd(spark):
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    texts = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (None, None), (4, long), (5, long), (5, long), (6, "a " * 60), (7, "\u0000é퟿" * 9)]
    rest = ["x"] * len(CLASHING.split())
    return spark.createDataFrame([(i, t, None if i == 4 else "en", None if i == 5 else "s", *rest) for i, t in texts], SCHEMA)


def operators(spark, docs):
    labels = docs.select("doc_id", F.lit(0).alias("toxic"), "text")
    benchmark = docs.select(F.col("doc_id").alias("item_id"), "text", "source").filter("doc_id = 6")
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "text")
    yield "op1", repetition.repetition(docs), True
    yield "op2", secrets.scan_secrets(docs), True
    yield "op3", disclosure.find_personal_data(docs), True
    yield "op4", paragraphs.repeated_paragraphs(docs), False
    yield "op5", toxicity.add_scores(docs, toxicity.fit(docs, labels)), True
    yield "op6", mincut.extract(pages), True
    yield "op7", jaccard.near_duplicates(docs), True
    yield "op8", mix(docs), False
    yield "op9", maglev.assign_shards(docs, SHARDS), True
    yield "op10", tiling.contaminated(docs, benchmark), False


def test_odd_tables(spark, odd):
    count = odd.count()
    for name, result, row_per_row in operators(spark, odd):
        rows = result.collect()
        assert len(rows) == count or not row_per_row, name
    by_name = {name: result for name, result, _ in operators(spark, odd)}
    assert {(r["doc_id"], r["item_id"]) for r in by_name["op10"].collect()} == {(6, 6)}
    assert {(r["doc_id"], r["keep_id"], r["removed"]) for r in by_name["op4"].collect()} == {(4, 4, False), (5, 4, True)}
    assert {(r["doc_id"], r["component_id"]) for r in by_name["op7"].filter("n_shingles > 5").collect()} == {(4, 4), (5, 4), }


def test_empty_tables(spark, odd):
    for name, result, _ in operators(spark, odd.limit(0)):
        assert result.count() == 0, name


def test_stages_on_odd_tables(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            result = stage(spark, table, str(DATA))
            assert set(odd.columns) <= {*result.columns, "slot", "mix_epoch"}, name
            assert result.count() <= docs.count() * 2
        docs = stage(spark, docs, str(DATA))


@data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    problem, rows = compare(spark, str(DATA), name)
    assert not problem and rows > 0


@data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, str(DATA)).count() > 0


@data
def test_pipeline_stages(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, str(DATA)).cache()
        by_stage[name] = (before, docs)
        assert docs.columns[: len(before.columns)] == before.columns
        assert docs.join(before, before.columns, "left_anti").count() == 0, "rows are not changed"
    before, after = by_stage["n-gram Jaccard join"]
    found = jaccard.near_duplicates(before)
    assert after.count() == found.select("component_id").distinct().count() < before.count()
    assert jaccard.near_duplicates(after).filter("component_id <> doc_id").count() == 0
    before, after = by_stage["benchmark decontamination"]
    bench = spark.read.parquet(str(DATA / "benchmark.parquet"))
    bad = tiling.contaminated(before, bench).select("doc_id").distinct()
    assert before.join(bad, "doc_id", "left_anti").count() == after.count()
    before, after = by_stage["sharding"]
    assert after.count() == before.count() and after.filter("shard is null").count() == 0
    final = corpus_pipeline.run(spark, str(DATA))
    assert sorted(r["doc_id"] for r in final.collect()) == sorted(r["doc_id"] for r in after.collect())
