"""From raw documents to placed training text, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.llm import jaccard, maglev, tiling
from gaugeframe.llm.queries import SHARDS, mix, read, score_toxicity
from gaugeframe.llm.rows import packed_rows
from gaugeframe.llm.storing import small, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.5
COPIES_TO_BROADCAST = 2_000_000


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine scores below the limit; labels are those of ``sf_dir``."""
    scored = score_toxicity(packed_rows(docs).select("row", "row.doc_id", "row.text"), read(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") < TOXIC_FROM).select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts stays, the one with the smallest id.

    Of rows of that component that repeat the id, the one with the smallest text stays; rows
    that share an id and have texts of other components are documents of their own.  Documents
    without words are linked with nothing and stay, as do rows without an id.
    """
    found = jaccard.text_components(docs).filter("id is not null").select("id", "text", "group", "component")
    found = stored(found, "texts")
    verdict = found.groupBy("id", "group").agg((F.max("component") == F.col("id")).alias("stays"), F.count("*").alias("rows"))
    verdict = verdict.filter(~F.col("stays") | (F.col("rows") > 1)).drop("rows")
    verdict = stored(found.join(verdict, ["id", "group"]).select("id", "text", "group", "stays").distinct(), "copies")
    packed = packed_rows(docs).withColumn("id", F.col("row.doc_id").cast("long")).withColumn("text", F.xxhash64("row.text"))
    keys = ["id", "text"]
    single = packed.join(small(verdict, COPIES_TO_BROADCAST), keys, "left_anti")
    repeated = packed.join(small(verdict.filter("stays").drop("stays"), COPIES_TO_BROADCAST), keys)
    first = repeated.groupBy("id", "group").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return single.select("row").union(first.select("row")).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture; a document of two epochs is there twice."""
    return mix(docs).select(*[f"`{c}`" for c in docs.columns])


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard."""
    return maglev.assign_shards(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

# SQL cannot learn the toxicity scores; the stages are tested one by one.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number}")
    return docs
