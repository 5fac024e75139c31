"""Selecting indicators of the catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.functions.grams import SIZE, grams
from gaugeframe.functions.matching import METACHARACTERS, folded, matches_any, matching_topics
from gaugeframe.operators.joins import BROADCAST_BYTES, join_on_key
from gaugeframe.schemas import CODE, NAME, require_columns
from gaugeframe.storage import cut_lineage


def select_indicators(
    catalog: DataFrame, terms: Sequence[str], literal: bool = False, position: str | None = None
) -> DataFrame:
    """Distinct (code, name) pairs whose name contains one of the terms.

    The filter runs before the distinct, whose first half runs before its
    shuffle.  ``position`` names a column of the catalogue with the place of the
    row; the first place of each pair is then kept.
    """
    require_columns(catalog, [CODE, NAME])
    kept = catalog.filter(matches_any(F.col(NAME), terms, literal))
    if position is None:
        return kept.select(CODE, NAME).dropDuplicates([CODE, NAME])
    return kept.groupBy(CODE, NAME).agg(F.min(position).alias(position))


def select_by_topic(
    catalog: DataFrame, patterns: Mapping[str, Sequence[str]], names: bool = True
) -> DataFrame:
    """Distinct (topic, code, name) for many topics in one pass over the catalogue.

    Each (code, name) is kept once before it is copied to its topics.  ``names=False`` gives
    (topic, code) and does not shuffle the names, which may be whole texts.

    The outer explode, filtered afterwards, matches every name once; for the
    inner one the optimizer adds a filter that matches it again.
    """
    require_columns(catalog, [CODE, NAME])
    found = matching_topics(F.col(NAME), patterns).alias("topics")
    if names:
        pairs = catalog.select(found, CODE, NAME).filter(F.size("topics") > 0).dropDuplicates([CODE, NAME])
        return pairs.select(F.explode("topics").alias("topic"), CODE, NAME)
    hits = catalog.select(F.explode_outer(found).alias("topic"), CODE).filter(F.col("topic").isNotNull())
    return hits.dropDuplicates(["topic", CODE])


def select_by_topic_table(
    catalog: DataFrame,
    topics: DataFrame,
    names: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    most_patterns: int = 1000,
) -> DataFrame:
    """As ``select_by_topic``, for any number of topics in a table (``topic``, ``term``).

    A plain term meets the names that have its rarest gram of three characters, and is then
    searched in these only.  Terms without a gram, and patterns, are few as a rule: they are
    literals of a plan of their own, and more than ``most_patterns`` of them are an error.  Null
    terms and topics match nothing; an empty term is an error.
    """
    require_columns(catalog, [CODE, NAME])
    spark = catalog.sparkSession
    folded_term = F.lower("term")
    plain = folded_term.rlike(rf"^[\x20-\x7e]{{{SIZE},}}$") & ~F.col("term").rlike(METACHARACTERS.pattern)
    wanted = cut_lineage(topics.select("topic", "term", folded_term.alias("folded"), plain.alias("plain")).dropna().distinct())
    apart = wanted.filter(~F.col("plain")).select("term").distinct().limit(most_patterns + 1).collect()
    if len(apart) > most_patterns:
        raise ValueError(f"more than {most_patterns} terms without a gram of {SIZE} characters to look them up by")
    pairs = catalog.select(CODE, NAME).filter(F.col(NAME).isNotNull()).dropDuplicates([CODE, NAME])
    pairs = cut_lineage(pairs.select(F.xxhash64(CODE, NAME).alias("id"), CODE, NAME))
    found = _met_terms(pairs, wanted.filter("plain").select("folded").distinct(), broadcast_bytes)
    hits = found.join(wanted.filter("plain").select("topic", "folded"), "folded").select("topic", CODE, NAME)
    if apart:
        by_term = {r["term"]: [r["term"]] for r in apart}
        others = select_by_topic(pairs, by_term).withColumnRenamed("topic", "term")
        others = others.join(wanted.filter(~F.col("plain")).select("topic", "term"), "term")
        hits = hits.union(others.select("topic", CODE, NAME))
    kept = ["topic", CODE, NAME] if names else ["topic", CODE]
    return hits.select(kept).distinct()


def topic_classes(topics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topics that have the same terms as one class, named by its smallest topic.

    Returns the terms of the classes (``topic``, ``term``), and the members (``topic``, ``class``).  What
    ``select_by_topic_table`` finds for a class holds for all its members, so it need not be copied to each.
    A topic's terms meet as one list.
    """
    listed = topics.select("topic", "term").dropna().groupBy("topic").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    listed = cut_lineage(listed)
    named = cut_lineage(listed.groupBy("terms").agg(F.min("topic").alias("class")))
    classes = named.select(F.col("class").alias("topic"), F.explode("terms").alias("term"))
    return classes, listed.join(named, "terms").select("topic", "class")


def _met_terms(pairs: DataFrame, terms: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The pairs (``id``, code, name) with every term (``folded``) that occurs in the name.

    Names are cut into grams once; grams that no term looks for are dropped before anything is
    shuffled.  A name then meets the terms of its grams as one list, not longer than the terms.
    """
    grammed = pairs.select("id", F.explode(grams(folded(F.col(NAME)))).alias("gram"))
    ends = F.sequence(F.lit(1), F.length("folded") - (SIZE - 1))
    of_terms = terms.select("folded", F.explode(F.transform(ends, lambda i: F.substring("folded", i, F.lit(SIZE)))).alias("gram"))
    of_terms = cut_lineage(of_terms.distinct())
    sought = join_on_key(grammed, of_terms.select("gram").distinct(), "gram", "left_semi", broadcast_bytes)
    counts = cut_lineage(sought.groupBy("gram").agg(F.count("*").alias("n")))
    # A gram that no name has rules its term out.
    known = of_terms.join(counts, "gram", "left")
    rarest = known.groupBy("folded").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.min(F.col("n").isNotNull()).alias("possible"))
    lookup = rarest.filter("possible").groupBy("gram").agg(F.collect_list("folded").alias("terms"))
    met = join_on_key(grammed, cut_lineage(lookup), "gram", "inner", broadcast_bytes)
    candidates = cut_lineage(met.groupBy("id").agg(F.flatten(F.collect_list("terms")).alias("terms")))
    near = join_on_key(pairs, candidates, "id", "inner", broadcast_bytes)
    text = F.array(folded(F.col(NAME)))
    hits = F.transform(text, lambda t: F.filter("terms", lambda term: t.contains(term)))[0]
    return near.select(CODE, NAME, F.explode(hits).alias("folded"))


def selection_order() -> list[Column]:
    """Order of a selection: code, then name, missing last."""
    return [F.col(CODE).asc_nulls_last(), F.col(NAME).asc_nulls_last()]


def with_ordinal(df: DataFrame, order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order, without a one-task window.

    The rows are range-sorted and stored once, so that both passes see the same
    partitions.  A row's number is its place within its partition plus the size
    of all partitions before it; the table of sizes has one row per partition.
    The order should tell the rows apart: rows that tie stay in one partition.
    """
    stored = cut_lineage(df.orderBy(*order))
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored.select("*", part.alias("__part"), place.alias("__place"))
    sizes = stored.groupBy(part.alias("__part")).count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset")
    )
    numbered = placed.join(F.broadcast(offsets), "__part")
    return numbered.withColumn(name, F.col("__offset") + F.col("__place")).drop(
        "__part", "__place", "__offset"
    )


def number_selection(selection: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number a selection from 0 by code and name."""
    return with_ordinal(selection, selection_order(), name)
