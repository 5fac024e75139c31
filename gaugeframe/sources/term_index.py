"""A stored index of names or whole texts, in which terms are looked up.

Four tables: ``names`` (id, code, name) in folders by a part of the id, ``postings`` (gram, id), each
file those of its own names in the order of the grams, so that a look-up reads the pages of its grams only,
``counts`` of the grams, of which there are some hundred thousand at most, and ``settings``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.functions.grams import SIZE, grams, grams_of, split_terms
from gaugeframe.functions.matching import folded, matches_any
from gaugeframe.operators.joins import BROADCAST_BYTES, join_on_key, measured_bytes
from gaugeframe.schemas import CODE, NAME, require_columns
from gaugeframe.storage import cut_lineage

FOLDERS = 64
LOOKED_UP = 2  # rarest grams of a literal, all of which a name has to have


def write_term_index(catalog: DataFrame, path: str, folders: int = FOLDERS) -> None:
    """Index the distinct (code, name) pairs of a catalogue; null names match nothing and are left out.

    An id is a hash of its pair.  Pairs that share one by chance are candidates together and are told
    apart when their names are searched.
    """
    require_columns(catalog, [CODE, NAME])
    spark = catalog.sparkSession
    spark.range(1).select(F.lit(folders).alias("folders")).write.mode("overwrite").parquet(f"{path}/settings")
    identity = F.xxhash64(CODE, NAME)
    named = catalog.select(CODE, NAME).filter(F.col(NAME).isNotNull()).dropDuplicates([CODE, NAME])
    named = named.select(identity.alias("id"), CODE, NAME, F.pmod(identity, F.lit(folders)).cast("int").alias("folder"))
    balanced = named.hint("rebalance", "folder")
    balanced.write.mode("overwrite").partitionBy("folder").parquet(f"{path}/names")
    stored = _names(spark, path)
    postings = stored.select(F.explode(grams(folded(F.col(NAME)))).alias("gram"), "id")
    # Sorted where they are made: postings are many times the names, and are not moved.  As a number,
    # a gram is sorted without comparing texts.
    order = reduce(lambda a, i: a * 128 + F.ascii(F.substring("gram", i, 1)), range(1, SIZE + 1), F.lit(0))
    placed = postings.sortWithinPartitions(order)
    placed.write.mode("overwrite").parquet(f"{path}/postings")
    counts = _postings(spark, path).groupBy("gram").agg(F.count("*").alias("n"))
    counts.repartitionByRange(1, "gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts")


def find_terms(spark: SparkSession, path: str, terms: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Distinct (code, name) of the index whose name contains one of the terms, as ``select_indicators`` finds them.

    A term is looked up by the rarest grams of a literal that its matches must have; names that have
    them are searched.  Terms without such a literal (less than three ASCII characters in a row
    that have to be there) are searched in all names.
    """
    matches_any(F.lit(""), terms)  # refuses empty lists and terms
    looked_up, rest = split_terms(terms)
    names = _names(spark, path)
    found = []
    if looked_up:
        ids = cut_lineage(candidates(spark, path, sorted({x for literals in looked_up.values() for x in literals})))
        small = measured_bytes(ids) <= broadcast_bytes
        # The folder is part of the key, so that folders without a candidate are not read; the filter
        # keeps every id, and tells the optimizer that they are a choice.
        ids = ids.filter("folder >= 0")
        key = F.struct("folder", "id")
        if small:
            near = names.join(F.broadcast(ids), ["folder", "id"], "left_semi")
        else:
            near = join_on_key(names.withColumn("key", key), ids.select(key.alias("key")), "key", "left_semi", small=False)
        found.append(near.filter(matches_any(F.col(NAME), list(looked_up))).select(CODE, NAME))
    if rest:
        found.append(names.filter(matches_any(F.col(NAME), rest)).select(CODE, NAME))
    return found[0] if len(found) == 1 else found[0].union(found[1]).dropDuplicates([CODE, NAME])


def candidates(spark: SparkSession, path: str, literals: Sequence[str]) -> DataFrame:
    """``folder`` and ``id`` of the names that have the rarest grams of one of the literals."""
    wanted = {literal: grams_of(literal) for literal in literals}
    every = sorted({g for found in wanted.values() for g in found})
    counts = {r["gram"]: r["n"] for r in spark.read.parquet(f"{path}/counts").filter(F.col("gram").isin(every)).collect()}
    chosen = [
        (number, gram, min(LOOKED_UP, len(found)))
        for number, found in enumerate(wanted.values())
        if all(g in counts for g in found)  # else no name has the literal
        for gram in sorted(found, key=lambda g: (counts[g], g))[:LOOKED_UP]
    ]
    lookup = spark.createDataFrame(chosen, "literal int, gram string, needed int")
    postings = _postings(spark, path).filter(F.col("gram").isin(sorted({gram for _, gram, _ in chosen})))
    # The look-up has as many rows as the caller's literals have grams chosen.
    met = postings.join(F.broadcast(lookup), "gram").groupBy("literal", "id").agg(F.count("*").alias("n"), F.first("needed").alias("needed"))
    ids = met.filter("n = needed").select("id").distinct()
    folders = spark.read.parquet(f"{path}/settings").first()["folders"]
    return ids.select(F.pmod("id", F.lit(folders)).cast("int").alias("folder"), "id")


def _names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"id long, {CODE} string, {NAME} string, folder int").parquet(f"{path}/names")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("gram string, id long").parquet(f"{path}/postings")
