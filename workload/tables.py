"""The given tables in the roles of the indicator data model.

Catalogue: ``part`` (key and name, every part under two entries, a name missing
now and then).  Observations: ``lineitem`` by the nation of its supplier, the
ship year and the part.  The tables hold no missing values, so nulls and NaN are
put in by rules on other columns; ``sql.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.plans.topics import TOPICS, Topic
from gaugeframe.schemas import CODE, NAME, NEXT_LINK, SPATIAL, TIME, VALUE

MEASURES = ("l_quantity", "l_extendedprice", "l_discount")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SHIP_YEARS = tuple(range(1995, 2002))
WIDE_KEYS = tuple((t, y) for t in PART_TYPES for y in SHIP_YEARS)

PART_TOPICS = (
    Topic("red", entity="COUNTRY/REGION"),
    Topic("rings_and_rods", ("RING", "rod", "ring of small"), null_policy="value", entity="REGION"),
    Topic("heat", ("hot (anvil|bolt)", "cold")),
    Topic("gizmo", ("gizmo",)),
    Topic("nothing", ("no such part",)),
)
TYPE_TOPICS = (Topic("size", ("SMALL", "medium")), Topic("price", ("economy", "promo")), Topic("rest", ("stand",)))
TOPIC_TERMS = tuple(term for topic in TOPICS for term in topic.patterns)
TEXT_TERMS = ("wash", "tion there", "ÉTION", "que la", "und (der|die)")
TEXT_TOPICS = {"stems": ("tion there", "wash"), "accents": ("ÉTION", "öre"), "articles": ("que la", "und (der|die)")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _catalog_entries() -> Column:
    first = F.when(F.col("p_size") != 50, F.col("p_name"))
    second = F.when(F.col("p_size") > 25, F.concat_ws(" of ", "p_name", "p_type")).otherwise(F.col("p_name"))
    return F.array(
        F.struct(_text("p_partkey").alias(CODE), first.alias(NAME)),
        F.struct(_text("p_partkey").alias(CODE), second.alias(NAME)),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "part").select(F.explode(_catalog_entries()).alias("entry"))
    return entries.select("entry.*")


def part_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as topics: each looks for names that end like its own, and some for a short or unknown one."""
    last = F.element_at(F.split("p_name", " "), -1)
    own = F.concat_ws(" of ", last, F.lower("p_type"))
    term = F.when(F.col("p_size") == 1, "ro").when(F.col("p_size") == 2, F.concat(own, F.lit(" and more"))).otherwise(own)
    return table(spark, sf_dir, "part").select(F.concat(F.lit("part "), "p_partkey").alias("topic"), term.alias("term"))


def landed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as landed pages: one page per part, with two entries."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("parts/"), _text("p_partkey")).alias("url"),
        F.lit(None).cast("string").alias("code"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(_catalog_entries().alias("value"))).alias("body"),
        F.col("p_partkey").alias("page_no"),
    )


def topical_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose names carry the built-in search terms in changing letter case."""
    terms = F.array(*[F.lit(t) for t in TOPIC_TERMS])
    term = F.element_at(terms, (F.col("p_partkey") % len(TOPIC_TERMS) + 1).cast("int"))
    cased = (
        F.when(F.col("p_size") % 3 == 0, F.upper(term)).when(F.col("p_size") % 3 == 1, F.lower(term)).otherwise(term)
    )
    plain = F.regexp_replace(cased, r"\(|\)", "")
    name = F.when(F.col("p_size") > 40, cased).otherwise(plain)
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias(CODE), F.concat_ws(" ", "p_name", name, "p_brand").alias(NAME)
    )


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the nation of their supplier.

    No hints: the file sizes decide whether suppliers are broadcast.
    """
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation")
    located = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return table(spark, sf_dir, "lineitem").join(located, F.col("l_suppkey") == F.col("s_suppkey"))


def _value() -> Column:
    nan = F.lit(float("nan"))
    return (
        F.when(F.col("l_discount") == 0.0, None).when(F.col("l_tax") == 0.08, nan).otherwise(F.col("l_extendedprice"))
    )


def _entity() -> Column:
    return F.when(F.col("l_linenumber") != 7, F.col("n_name"))


def _year() -> Column:
    return F.year("l_shipdate")


def observations(spark: SparkSession, sf_dir: str, code: Column | None = None, all_years: bool = False) -> DataFrame:
    """Order lines as raw observations; ``Dim1`` is a column the operators do not need."""
    year = _year() if all_years else F.when(F.col("l_quantity") != 50.0, _year())
    return _located(spark, sf_dir).select(
        _entity().alias(SPATIAL),
        year.alias(TIME),
        (_text("l_partkey") if code is None else code).alias(CODE),
        _value().alias(VALUE),
        F.col("l_returnflag").alias("Dim1"),
    )


def skewed_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all rows under one code."""
    return observations(spark, sf_dir, F.when(F.col("l_returnflag") == "R", "7").otherwise(_text("l_partkey")))


def typed_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations whose code is the part type, so that there are few wide columns."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    typed = _located(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return typed.select(
        _entity().alias(SPATIAL),
        F.when(F.col("l_quantity") != 50.0, _year()).alias(TIME),
        F.col("p_type").alias(CODE),
        _value().alias(VALUE),
        F.col("l_returnflag").alias("Dim1"),
    )


def landed_observations(spark: SparkSession, sf_dir: str, code: str = "l_linestatus") -> DataFrame:
    """Order lines as landed pages with one row per measure; the payload code is wrong."""
    rows = F.array(
        *[
            F.struct(
                _text("l_suppkey").alias(SPATIAL),
                F.year("l_shipdate").alias(TIME),
                F.lit("payload").alias(CODE),
                F.col(m).alias(VALUE),
                F.col("l_returnflag").alias("Dim1"),
            )
            for m in MEASURES
        ]
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", F.lit("lines"), "l_orderkey", "l_linenumber").alias("url"),
        _text(code).alias("code"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(rows.alias("value"))).alias("body"),
    )


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed pages: finished ones failed, pending ones are empty."""
    status = F.col("o_orderstatus")
    row = F.struct(
        F.col("o_orderpriority").alias(SPATIAL), F.year("o_orderdate").alias(TIME), F.col("o_totalprice").alias(VALUE)
    )
    full = F.to_json(F.struct(F.array(row).alias("value")))
    body = F.when(status == "F", '{"error": {"message": "not found"}}').when(status == "P", '{"value": []}')
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders/"), _text("o_orderkey")).alias("url"),
        _text("o_custkey").alias("code"),
        F.when(status == "F", 404).otherwise(200).alias("status"),
        body.otherwise(full).alias("body"),
    )


def repeated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed orders, ``fetched`` twice as a rule: failed ones succeed later, some others fail later,
    and some have another value; every fifth has no second page, every eleventh an equal one."""
    first = landed_orders(spark, sf_dir)
    key = F.col("url").substr(F.lit(8), F.length("url")).cast("long")
    changed = F.replace(F.col("body"), F.lit('"TimeDim":'), F.lit('"Dim1":"again","TimeDim":1'))
    fixed = F.lit('{"value":[{"SpatialDim":"late","TimeDim":2024,"NumericValue":1.5}]}')
    status = F.when(F.col("status") == 404, 200).when(key % 3 == 0, 500).otherwise(200)
    body = F.when(F.col("status") == 404, fixed).when(key % 11 == 0, F.col("body")).otherwise(changed)
    second = first.filter(key % 5 != 0).withColumns({"body": body, "status": F.when(key % 11 == 0, 200).otherwise(status)})
    return first.withColumn("fetched", F.lit(1)).unionByName(second.withColumn("fetched", F.lit(2)))


def landed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as landed catalogue pages, named by their market segment."""
    entry = F.struct(_text("c_custkey").alias(CODE), F.col("c_mktsegment").alias(NAME))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("customers/"), _text("c_custkey")).alias("url"),
        F.lit(None).cast("string").alias("code"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(F.array(entry).alias("value"))).alias("body"),
    )


def order_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed pages, each naming the next order as next page; finished ones failed."""
    link = F.concat(F.lit("orders/"), (F.col("o_orderkey") + 1).cast("string")).alias(NEXT_LINK)
    none = F.array().cast("array<string>").alias("value")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders/"), _text("o_orderkey")).alias("url"),
        F.when(F.col("o_orderstatus") == "F", 404).otherwise(200).alias("status"),
        F.to_json(F.struct(none, link)).alias("body"),
    )


def order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed pages in chains of 1,000, with ends, short cuts and loops by rules on the key.

    Every 1,000th page ends its chain, every 250th but those skips the next page, every 170th leads
    ten pages back, and of every 90th one there are two, the other one with a link to a lost page.
    """
    key = F.col("o_orderkey")
    ahead = F.when(key % 250 == 249, 2).when(key % 170 == 169, -10).otherwise(1)
    to = F.when(key % 1000 != 999, F.concat(F.lit("orders/"), (key + ahead).cast("string")))
    links = F.when(key % 90 == 89, F.array(to, F.concat(F.lit("orders/lost"), key))).otherwise(F.array(to))
    none = F.array().cast("array<string>").alias("value")
    pages = table(spark, sf_dir, "orders").select(key, F.explode(links).alias(NEXT_LINK))
    return pages.select(
        F.concat(F.lit("orders/"), _text("o_orderkey")).alias("url"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(none, F.col(f"`{NEXT_LINK}`"))).alias("body"),
    )


def broken_orders(spark: SparkSession, sf_dir: str, failed: bool = False) -> DataFrame:
    """Orders as landed pages of status 200, most of them broken by a rule on the key.

    With ``failed`` finished orders have another status.
    """
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    value = F.when(F.col("o_orderkey") % 7 == 5, F.concat(F.lit('"'), price, F.lit('"'))).otherwise(price)
    value = F.when(F.col("o_orderkey") % 7 == 4, '"n/a"').otherwise(value)
    row = F.concat(F.lit('{"SpatialDim":"'), "o_orderpriority", F.lit('","TimeDim":1998,"NumericValue":'), value, F.lit("}"))
    page = F.concat(F.lit('{"value":['), row, F.lit("]}"))
    body = (
        F.when(F.col("o_orderkey") % 7 == 0, "<html>busy</html>")
        .when(F.col("o_orderkey") % 7 == 1, page.substr(F.lit(1), F.length(page) - 4))
        .when(F.col("o_orderkey") % 7 == 2, '{"error":"busy"}')
        .when(F.col("o_orderkey") % 7 == 3, F.replace(page, F.lit("}]}"), F.lit('},{"SpatialDim":"X","TimeDim":1999,"NumericValue":"?"}]}')))
        .otherwise(page)
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders/"), _text("o_orderkey")).alias("url"),
        _text("o_custkey").alias("code"),
        F.when(F.lit(failed) & (F.col("o_orderstatus") == "F"), 500).otherwise(200).alias("status"),
        body.alias("body"),
    )


def varied_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as pages whose rows have different columns and types, by line number.

    Some years are texts, some discounts whole numbers, some rows have a level of their own or a
    note that is null, and every seventh line has an error body.
    """
    number = F.col("l_linenumber")
    first = [F.col("l_returnflag").alias(SPATIAL), F.col("l_extendedprice").alias(VALUE)]
    whole = F.struct(*first, F.year("l_shipdate").alias(TIME), F.col("l_quantity").cast("long").alias("Low"), (number == 1).alias("Final"))
    typed = F.struct(*first, F.year("l_shipdate").cast("string").alias(TIME), F.col("l_discount").alias("Low"))
    nested = F.struct(*first, F.struct(F.col("l_linenumber").alias("n"), F.col("l_linestatus").alias("s")).alias("Dim 1"))
    body = (
        F.when(number == 7, '{"error": "busy"}')
        .when(number % 3 == 0, F.to_json(F.struct(F.array(nested).alias("value"))))
        .when(number % 3 == 1, F.to_json(F.struct(F.array(whole).alias("value"))))
        .otherwise(F.to_json(F.struct(F.array(typed).alias("value"))))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", F.lit("lines"), "l_orderkey", "l_linenumber").alias("url"),
        _text("l_suppkey").alias("code"),
        F.lit(200).alias("status"),
        body.alias("body"),
    )


def landed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as pages whose year is 1998, 1998.0, 1998.7 or "1998", by line number."""
    year = F.year("l_shipdate").cast("string")
    number = F.col("l_linenumber") % 4
    written = F.when(number == 1, F.concat(year, F.lit(".0"))).when(number == 2, F.concat(year, F.lit(".7")))
    written = written.when(number == 3, F.concat(F.lit('"'), year, F.lit('"'))).otherwise(year)
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", F.lit("lines"), "l_orderkey", "l_linenumber").alias("url"),
        F.col("l_linestatus").alias("code"),
        F.lit(200).alias("status"),
        F.concat(F.lit('{"value":[{"SpatialDim":"A","TimeDim":'), written, F.lit("}]}")).alias("body"),
    )


def numbered_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types as a catalogue whose names do not hold the codes."""
    place = F.array_position(F.array(*map(F.lit, PART_TYPES)), F.col("p_type"))
    return table(spark, sf_dir, "part").select(F.col("p_type").alias(CODE), F.concat(F.lit("group "), place).alias(NAME))
