"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.matching import matches_any
from gaugeframe.functions.numbers import whole_year
from gaugeframe.operators.facts import ensure_not_empty, indicators_without_data, observations_for, union_all
from gaugeframe.operators.profile import preview, row_count, shape
from gaugeframe.operators.reshape import (
    clean_long,
    column_dictionary,
    mean_cells,
    pivot_wide,
    prune,
    rename,
    unpivot_wide,
)
from gaugeframe.operators.sparse import sparse_cells, sparse_slice, write_sparse
from gaugeframe.operators.selection import (
    number_selection,
    select_by_topic,
    select_by_topic_table,
    select_indicators,
    topic_classes,
    with_ordinal,
)
from gaugeframe.plans.export import export_topics, export_with_report, report_of
from gaugeframe.plans.topics import (
    TOPICS,
    all_topics_cells,
    all_topics_long,
    run_landed_topic,
    run_topic,
    topic_named,
    topic_wide,
)
from gaugeframe.schemas import CATALOG, CODE, NAME, NEEDED, SPATIAL, TIME, VALUE, YEAR, require_columns
from gaugeframe.sinks.csv import CSV_FORMAT, wide_csv_lines, write_long_csv, write_wide_csv
from gaugeframe.sources.accounting import AccountedScan
from gaugeframe.sources.chain import walk_pages
from gaugeframe.sources.clustered import read_clustered, write_clustered
from gaugeframe.sources.inferred import infer_rows
from gaugeframe.sources.landing import (
    audit_page_chain,
    decode_pages,
    fail_on_error,
    latest_pages,
    page_links,
    readable_observations,
    refused_pages,
    scan_catalog,
    scan_observation_files,
    scan_observations,
    unnest_rows,
    unreadable_pages,
    write_page_files,
)
from gaugeframe.sources.observations import read_observations, write_observations
from gaugeframe.sources.term_index import find_terms, write_term_index
from gaugeframe.storage import scratch_path
from gaugeframe.streaming.intake import append_observations, read_intake, stream_landed
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]
RINGS = ("ring", "Bolt", "hot (rod|gear)")


# Sources


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_catalog(t.landed_catalog(spark, sf_dir))


def page_chain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of real page bodies; failed pages do not count as landed."""
    return audit_page_chain(page_links(t.order_chain(spark, sf_dir)))


def page_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of all pages from every 1,000th on, and what breaks the chains."""
    links = page_links(t.order_links(spark, sf_dir))
    starts = t.table(spark, sf_dir, "orders").filter("o_orderkey % 1000 = 0").select(F.concat(F.lit("orders/"), "o_orderkey").alias("url"))
    return walk_pages(links, starts)


def observation_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store by code, read back the selected codes only."""
    path = scratch_path(spark, "observations")
    write_observations(t.typed_observations(spark, sf_dir).select(*NEEDED), path)
    chosen = select_indicators(t.numbered_types(spark, sf_dir), ["group 1", "group 3"])
    return clean_long(observations_for(read_observations(spark, path), chosen))


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_observations(t.landed_observations(spark, sf_dir))
    units = F.round(F.col(VALUE) * 100).cast("long")
    return rows.groupBy(SPATIAL, TIME).agg(F.count("*").alias("n"), F.sum(units).alias("units"))


def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of the events, taken as pages with one row."""
    pages = t.table(spark, sf_dir, "events").select(
        "event_id",
        F.lit(200).alias("status"),
        F.concat(F.lit('{"value": ['), F.col("props"), F.lit("]}")).alias("body"),
    )
    row = T.StructType([T.StructField("k", T.IntegerType())])
    return unnest_rows(decode_pages(pages, row), keep=("event_id",))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files in one folder per code, read back for the selected codes."""
    path = scratch_path(spark, "pages")
    write_page_files(t.landed_observations(spark, sf_dir), path)
    lines = t.table(spark, sf_dir, "lineitem")
    name = F.when(F.col("l_linestatus") == "O", "not yet paid").otherwise("done")
    status = lines.select(F.col("l_linestatus").alias(CODE), name.alias(NAME))
    rows = observations_for(scan_observation_files(spark, path), select_indicators(status, ["PAID"]))
    return rows.groupBy(CODE, SPATIAL, TIME).agg(F.count("*").alias("n"))


def failed_pages_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_observations(t.landed_orders(spark, sf_dir), on_error="skip")


def page_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed orders as a file stream, taken in twice: every page counts once."""
    folder = scratch_path(spark, "intake")
    t.landed_orders(spark, sf_dir).write.json(f"{folder}/landing")
    for _ in range(2):
        landed = stream_landed(spark, f"{folder}/landing")
        append_observations(landed, f"{folder}/table", f"{folder}/progress").awaitTermination()
    return read_intake(spark, f"{folder}/table")


def pages_landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of the last accepted page of every address."""
    return scan_observations(latest_pages(t.repeated_orders(spark, sf_dir), "fetched"))


def page_intake_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed and taken in one after the other: the first accepted one of every address counts."""
    folder = scratch_path(spark, "intake")
    pages = t.repeated_orders(spark, sf_dir)
    for fetched in (1, 2):
        pages.filter(F.col("fetched") == fetched).drop("fetched").write.mode("append").json(f"{folder}/landing")
        landed = stream_landed(spark, f"{folder}/landing")
        append_observations(landed, f"{folder}/table", f"{folder}/progress").awaitTermination()
    return read_intake(spark, f"{folder}/table")


def failed_pages_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that stop a job, and the good pages that do not."""
    landed = t.landed_orders(spark, sf_dir)
    good = fail_on_error(landed.filter(F.col("status") == 200)).groupBy("status")
    passed = good.agg(F.count("body").cast("string").alias("what"))
    return refused_pages(landed).select("status", F.col("url").alias("what")).unionByName(passed)


def unreadable_pages_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies broken in several ways: what is named as unreadable, and what is still read."""
    landed = t.broken_orders(spark, sf_dir)
    named = unreadable_pages(landed).select("url", F.col("problem").alias("found"))
    read = readable_observations(landed).select(
        F.concat(F.lit("customer/"), CODE).alias("url"),
        F.concat_ws("|", SPATIAL, TIME, F.round(F.col(VALUE) * 100).cast("long")).alias("found"),
    )
    return named.unionByName(read)


def pages_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of pages that differ in columns and types; pages without rows have none."""
    return infer_rows(t.varied_pages(spark, sf_dir))


def pages_without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error bodies of status 200 under both policies: what is read, and what is named."""
    landed = t.broken_orders(spark, sf_dir).filter("substring(url, 8) % 7 in (2, 5, 6)")
    read = scan_observations(landed, on_missing="none").select(
        F.lit("none").alias("policy"), F.col(CODE).alias("what"), F.round(F.col(VALUE) * 100).cast("long").alias("units")
    )
    named = unreadable_pages(landed).select(F.lit("fail").alias("policy"), F.concat_ws(" ", "url", "problem").alias("what"))
    return read.unionByName(named, allowMissingColumns=True)


def json_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years as whole and fractional JSON numbers and as text."""
    years = clean_long(scan_observations(t.landed_years(spark, sf_dir)))
    return years.groupBy(CODE, YEAR).agg(F.count("*").alias("n"))


# Filters, projections, scalar functions


def one_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.catalog(spark, sf_dir).filter(matches_any(F.col(NAME), ["RING"]))


def any_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_indicators(t.catalog(spark, sf_dir), RINGS)


def any_term_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = t.table(spark, sf_dir, "documents")
    texts = documents.select(F.col("doc_id").cast("string").alias(CODE), F.col("text").alias(NAME))
    return select_indicators(texts, t.TEXT_TERMS).select(CODE, F.length(NAME).alias("n_chars"))


def indexed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index of the catalogue, in which three lists of terms are looked up."""
    path = scratch_path(spark, "terms")
    write_term_index(t.catalog(spark, sf_dir), path)
    lists = {"any": RINGS, "types": ("of medium", "of Promo|gizmo of"), "rare": ("ll rod of s", "no such part")}
    return union_all([find_terms(spark, path, x).withColumn("list", F.lit(name)) for name, x in lists.items()])


def indexed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms of ``any_term_documents``, from an index of the texts."""
    path = scratch_path(spark, "texts")
    documents = t.table(spark, sf_dir, "documents")
    write_term_index(documents.select(F.col("doc_id").cast("string").alias(CODE), F.col("text").alias(NAME)), path)
    return find_terms(spark, path, t.TEXT_TERMS).select(CODE, F.length(NAME).alias("n_chars"))


def pattern_and_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parentheses in a term: a group by default, themselves on request."""
    ending = F.when(F.col("p_size") % 2 == 0, "(s)").otherwise("s")
    named = t.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias(CODE), F.concat("p_name", ending).alias(NAME)
    )
    terms = ["Ring(s)", "rod(s)"]
    return named.select(
        CODE,
        matches_any(F.col(NAME), terms).alias("as_pattern"),
        matches_any(F.col(NAME), terms, literal=True).alias("as_literal"),
    )


def null_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = t.catalog(spark, sf_dir).withColumn("hit", matches_any(F.col(NAME), ["ring"]))
    return flagged.groupBy("hit", F.col(NAME).isNull().alias("nameless")).agg(F.count("*").alias("n"))


def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any name matches; other columns of the catalogue are left out."""
    return select_indicators(t.topical_catalog(spark, sf_dir).withColumn("Language", F.lit("EN")), ["."])


def requested_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_observations(t.landed_observations(spark, sf_dir))
    return rows.groupBy(CODE).agg(F.count("*").alias("n"))


# Joins


def selected_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code selected under two names comes twice."""
    chosen = select_indicators(t.catalog(spark, sf_dir), RINGS)
    return clean_long(observations_for(t.observations(spark, sf_dir), chosen))


def selected_observations_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_indicators(t.catalog(spark, sf_dir), RINGS)
    return clean_long(observations_for(t.observations(spark, sf_dir), chosen, dedupe=True))


def selected_observations_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection too large to broadcast, and one code with a third of the rows."""
    chosen = select_indicators(t.catalog(spark, sf_dir), ("o", "ring"))
    return clean_long(observations_for(t.skewed_observations(spark, sf_dir), chosen, broadcast_bytes=0))


def clustered_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code per part in clustered files, of which the chosen ones are read."""
    path = scratch_path(spark, "clustered")
    write_clustered(t.observations(spark, sf_dir).select(*NEEDED), path)
    chosen = select_indicators(t.catalog(spark, sf_dir), ("gear", "rod of ring"))
    return clean_long(read_clustered(spark, path, chosen))


def selected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as pages of a third of the parts, a selection too large to broadcast: bodies of others stay."""
    pages = t.landed_observations(spark, sf_dir, "l_partkey")
    chosen = t.catalog(spark, sf_dir).filter(F.col(CODE) % 3 == 0)
    near = observations_for(pages, chosen, dedupe=True, broadcast_bytes=0, key="code")
    return scan_observations(near).groupBy(CODE).agg(F.count("*").alias("n"))


def indicators_lacking_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third part has its observations under another code."""
    chosen = select_indicators(t.catalog(spark, sf_dir), ("ring", "gizmo"))
    code = F.when(F.col("l_partkey") % 3 == 0, "none").otherwise(F.col("l_partkey").cast("string"))
    return indicators_without_data(chosen, t.observations(spark, sf_dir, code))


# Set operations, sorts, limits


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = t.table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias(VALUE), F.col("c_name").alias(SPATIAL), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias(SPATIAL), F.col("s_acctbal").alias(VALUE), F.col("s_nationkey").alias("nation")
    )
    return union_all([customers, suppliers, suppliers])


def non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ensure_not_empty(t.observations(spark, sf_dir))
    return rows.groupBy("Dim1").agg(F.count("*").alias("n"))


def distinct_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_indicators(t.catalog(spark, sf_dir), ["."])


def numbered_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_selection(select_indicators(t.catalog(spark, sf_dir), RINGS))


def catalog_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selection that keeps the place of each indicator in the whole catalogue."""
    pages = decode_pages(t.landed_catalog(spark, sf_dir), CATALOG)
    entries = unnest_rows(pages, keep=("page_no",), position="place")
    placed = with_ordinal(entries, [F.col("page_no").asc(), F.col("place").asc()], "index")
    return select_indicators(placed, RINGS, position="index")


def first_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_indicators(t.catalog(spark, sf_dir), RINGS)
    return preview(chosen, [F.col(CODE).asc_nulls_last(), F.col(NAME).asc_nulls_last()])


# Aggregations


def catalog_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(scan_catalog(t.landed_catalog(spark, sf_dir)))


def collected_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_indicators(t.catalog(spark, sf_dir), RINGS)
    return shape(observations_for(t.observations(spark, sf_dir), chosen))


def grouped_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_cells(clean_long(t.typed_observations(spark, sf_dir)), scale=2)


def grouped_mean_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unscaled mean, whose last digits depend on the order of the rows.

    The offset keeps exact halves away from the place where both sides round.
    """
    cells = mean_cells(clean_long(t.typed_observations(spark, sf_dir)))
    return cells.withColumn(VALUE, F.round(F.col(VALUE) + 0.0000123, 4))


def grouped_mean_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly as many groups as rows."""
    return mean_cells(clean_long(t.observations(spark, sf_dir)), scale=2)


def grouped_mean_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of unrounded doubles, the same bits under any order of the rows."""
    return mean_cells(clean_long(t.observations(spark, sf_dir)), exact=True)


def wide_known_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_wide(grouped_mean(spark, sf_dir), keys=t.WIDE_KEYS)


def wide_discovered_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_wide(grouped_mean(spark, sf_dir))


def wide_many_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as entities: the number of wide rows grows with the data."""
    lines = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias(SPATIAL),
        F.year("l_shipdate").alias(TIME),
        F.col("l_returnflag").alias(CODE),
        F.col("l_extendedprice").alias(VALUE),
    )
    keys = [(flag, year) for flag in "ANR" for year in t.SHIP_YEARS]
    return pivot_wide(mean_cells(clean_long(lines), scale=2), keys=keys)


def wide_to_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_wide(wide_known_keys(spark, sf_dir), "COUNTRY", t.WIDE_KEYS)


def entities_without_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of the long table that have no wide row, as all their values are missing."""
    region = F.col(SPATIAL).substr(-1, 1)
    emptied = t.observations(spark, sf_dir).withColumn(VALUE, F.when(~region.isin("1", "4"), F.col(VALUE)))
    long = clean_long(emptied)
    kept = mean_cells(long).select("COUNTRY").distinct()
    return long.select("COUNTRY").distinct().join(kept, "COUNTRY", "left_anti")


def wide_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_dictionary(mean_cells(clean_long(t.observations(spark, sf_dir)), scale=2))


# Cleaning


def checked_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = require_columns(t.observations(spark, sf_dir), NEEDED)
    return rows.groupBy(TIME, "Dim1").agg(F.count("*").alias("n"))


def pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = t.observations(spark, sf_dir).withColumn(VALUE, F.nanvl(VALUE, F.lit(-1.0)))
    return prune(plain)


def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = t.observations(spark, sf_dir).withColumn(VALUE, F.nanvl(VALUE, F.lit(-1.0)))
    return rename(prune(plain), "COUNTRY/REGION")


def long_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_long(t.observations(spark, sf_dir), "COUNTRY/REGION")


def long_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_long(t.observations(spark, sf_dir, all_years=True), "REGION", null_policy="value")


def whole_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional years are cut off; unreadable text becomes null when allowed."""
    lines = t.table(spark, sf_dir, "lineitem")
    fraction = F.year("l_shipdate") + F.col("l_discount") * 9
    text = F.concat(F.year("l_shipdate").cast("string"), F.when(F.col("l_returnflag") == "R", ".0").otherwise(""))
    years = lines.select(whole_year(fraction).alias("cut"), whole_year(text, lenient=True).alias("lenient"))
    return years.groupBy("cut", "lenient").agg(F.count("*").alias("n"))


# Sinks


def long_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "long-csv")
    write_long_csv(clean_long(t.observations(spark, sf_dir)), path)
    schema = "COUNTRY string, YEAR int, IndicatorCode string, NumericValue double"
    return spark.read.schema(schema).options(header=True, **CSV_FORMAT).csv(path)


def wide_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wide-csv")
    write_wide_csv(grouped_mean(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def wide_csv_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per part and year, far more than a table may have fields."""
    path = scratch_path(spark, "wide-csv")
    write_wide_csv(grouped_mean_many(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def wide_csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every line of the wide file."""
    lines = wide_csv_lines(grouped_mean(spark, sf_dir), t.WIDE_KEYS)
    numbered = with_ordinal(lines, [F.col("section").asc(), F.col("entity").asc()])
    return numbered.select("ordinal", F.substring_index("line", ",", 1).alias("first_field"))


# Topics


def topic_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = topic_named("heat", t.PART_TOPICS)
    return run_topic(t.catalog(spark, sf_dir), t.observations(spark, sf_dir), topic).long


def topic_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic from catalogue to wide table; indicators are part types."""
    parts = t.table(spark, sf_dir, "part").select(F.col("p_type").alias(CODE), F.col("p_type").alias(NAME))
    topic = t.Topic("size", ("SMALL", "medium", "lar(ge)"), entity="COUNTRY/REGION")
    keys = [k for k in t.WIDE_KEYS if k[0] in ("LARGE", "MEDIUM", "SMALL")]
    return run_topic(parts, t.typed_observations(spark, sf_dir), topic, keys=keys, scale=2).wide


def topic_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic from landed pages; only pages of selected codes are parsed."""
    topic = t.Topic("segments", ("BUILD", "chin(e)"))
    landed = t.landed_customers(spark, sf_dir), t.landed_orders(spark, sf_dir)
    return run_landed_topic(*landed, topic).long


def topic_wide_from_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table of one topic out of the means of many."""
    parts = t.table(spark, sf_dir, "part").select(F.col("p_type").alias(CODE), F.col("p_type").alias(NAME))
    topics = (t.Topic("size", ("SMALL", "medium")), t.Topic("price", ("economy", "promo"), entity="REGION"))
    cells = all_topics_cells(parts, t.typed_observations(spark, sf_dir), topics, scale=2)
    keys = [k for k in t.WIDE_KEYS if k[0] in ("ECONOMY", "PROMO")]
    return topic_wide(cells, topics[1], keys=keys)


def all_topics_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built-in topics."""
    return select_by_topic(t.topical_catalog(spark, sf_dir), {x.name: x.patterns for x in TOPICS})


def all_topics_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built-in topics on whole texts, and three that occur in them."""
    documents = t.table(spark, sf_dir, "documents")
    texts = documents.select(F.col("doc_id").cast("string").alias(CODE), F.col("text").alias(NAME))
    patterns = {x.name: x.patterns for x in TOPICS} | t.TEXT_TOPICS
    return select_by_topic(texts, patterns, names=False)


def topics_as_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built-in topics as rows of a table."""
    rows = [(x.name, term) for x in TOPICS for term in x.patterns]
    topics = spark.createDataFrame(rows, "topic string, term string")
    return select_by_topic_table(t.topical_catalog(spark, sf_dir), topics)


def topics_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic per part, which looks for names like its own: how many codes each has."""
    classes, members = topic_classes(t.part_terms(spark, sf_dir))
    hits = select_by_topic_table(t.catalog(spark, sf_dir), classes, names=False).withColumnRenamed("topic", "class")
    counts = hits.groupBy("class").agg(F.count("*").alias("n_codes"), F.min(F.col(CODE).cast("long")).alias("first_code"))
    return members.join(counts, "class").select("topic", "n_codes", "first_code")


def all_topics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.observations(spark, sf_dir, all_years=True)
    return all_topics_long(t.catalog(spark, sf_dir), rows, t.PART_TOPICS)


def all_topics_rows_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.observations(spark, sf_dir, all_years=True)
    return all_topics_long(t.catalog(spark, sf_dir), rows, t.PART_TOPICS, broadcast_bytes=0)


def all_topics_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_topics_cells(t.topical_catalog(spark, sf_dir), t.observations(spark, sf_dir), TOPICS, scale=2)


def all_topics_means_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.skewed_observations(spark, sf_dir)
    return all_topics_cells(t.topical_catalog(spark, sf_dir), rows, TOPICS, scale=2, broadcast_bytes=0)


def exported_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long and wide CSV of several topics, written from one scan and read back."""
    parts = t.table(spark, sf_dir, "part").select(F.col("p_type").alias(CODE), F.col("p_type").alias(NAME))
    path = scratch_path(spark, "export")
    export_topics(parts, t.typed_observations(spark, sf_dir), path, t.TYPE_TOPICS, scale=2)
    lines = []
    for topic in t.TYPE_TOPICS:
        for kind in ("long", "wide"):
            text = spark.read.text(f"{path}/{topic.name}/{kind}").withColumnRenamed("value", "line")
            lines.append(text.select(F.lit(topic.name).alias("topic"), F.lit(kind).alias("kind"), "line"))
    header = ",".join((t.TYPE_TOPICS[0].entity, YEAR, CODE, VALUE))
    return union_all(lines).filter(F.col("line") != header)


def wide_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide table with more columns than a schema should have, stored sparsely and read back."""
    path = scratch_path(spark, "sparse")
    write_sparse(grouped_mean_many(spark, sf_dir), path)
    return sparse_cells(spark, path)


def wide_sparse_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some columns of such a table, from two blocks, as rows again."""
    path = scratch_path(spark, "sparse")
    write_sparse(grouped_mean_many(spark, sf_dir), path, block=512)
    found = sparse_slice(spark, path, 500, 40)
    keys = [(name.rpartition("|")[0], int(name.rpartition("|")[2])) for name in found.columns[1:]]
    return unpivot_wide(found, "COUNTRY", keys)


def accounted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and rows by what became of them, counted by the job that reads them."""
    scan = AccountedScan(t.broken_orders(spark, sf_dir, failed=True), on_unreadable="mark")
    kept = scan.rows.count()
    counts = {**vars(scan.counts), "kept": kept}
    return spark.createDataFrame(list(counts.items()), "what string, n long")


def export_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all topics of an export over the parts, and how many of the codes of each had no data."""
    path = scratch_path(spark, "report")
    facts = t.observations(spark, sf_dir, all_years=True).filter(F.col(CODE) % 4 != 0)
    report = export_with_report(t.catalog(spark, sf_dir), facts, f"{path}/out", t.PART_TOPICS, report_path=f"{path}/report")
    assert report.without_rows == ["nothing"]
    tables = report_of(spark, f"{path}/report")
    lacking = tables["without_data"].groupBy("topic").agg(F.count("*").alias("listed"))
    counts = tables["counts"].select("topic", *[F.col(c).cast("long").alias(c) for c in tables["counts"].columns[1:]])
    return counts.join(lacking, "topic", "left").fillna(0, ["listed"])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        catalog_scan,
        page_chain_audit,
        page_walk,
        observation_scan,
        page_rows,
        event_properties,
        page_files,
        failed_pages_skipped,
        page_intake,
        pages_landed_twice,
        page_intake_repeated,
        failed_pages_refused,
        unreadable_pages_named,
        pages_inferred,
        pages_without_rows,
        json_years,
        one_term,
        any_term,
        any_term_documents,
        indexed_terms,
        indexed_documents,
        pattern_and_literal,
        null_names,
        projection,
        requested_code,
        selected_observations,
        selected_observations_once,
        selected_observations_shuffled,
        clustered_observations,
        selected_pages,
        indicators_lacking_data,
        union_by_name,
        non_empty,
        distinct_indicators,
        numbered_indicators,
        catalog_positions,
        first_indicators,
        catalog_size,
        collected_shape,
        grouped_mean,
        grouped_mean_plain,
        grouped_mean_many,
        grouped_mean_exact,
        wide_known_keys,
        wide_discovered_keys,
        wide_many_entities,
        wide_to_cells,
        entities_without_values,
        wide_columns,
        checked_columns,
        pruned,
        renamed,
        long_by_keys,
        long_by_value,
        whole_years,
        long_csv,
        wide_csv,
        wide_csv_many,
        wide_csv_order,
        topic_long,
        topic_wide_table,
        topic_from_pages,
        topic_wide_from_all,
        all_topics_selection,
        all_topics_documents,
        topics_as_table,
        topics_of_parts,
        all_topics_rows,
        all_topics_rows_shuffled,
        all_topics_means,
        all_topics_means_shuffled,
        wide_sparse,
        wide_sparse_slice,
        exported_topics,
        export_report,
        accounted_pages,
    )
}
