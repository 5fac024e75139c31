"""Landed response pages: status policy, JSON decoding, unnesting, chain audit.

A landing table has the columns of ``schemas.LANDED``.  Everything here except
the audit is map-only, and works on batch and streaming frames alike.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.numbers import data_error, input_error
from gaugeframe.operators.bloom import keep_possible
from gaugeframe.operators.joins import BROADCAST_BYTES, join_on_key, measured_bytes
from gaugeframe.schemas import (
    CATALOG,
    CODE,
    LANDED,
    NEXT_LINK,
    OBSERVATION,
    PROBLEM,
    ROWS,
    TIME,
    UNREADABLE,
    VALUE,
    page_schema,
)
from gaugeframe.storage import cut_lineage

OnError = Literal["skip", "fail"]
# What becomes of bodies and values that cannot be read: the job stops, or they
# stay with a ``problem`` for ``unreadable_pages``.  They never vanish.
OnUnreadable = Literal["fail", "mark"]
# What becomes of readable pages without a list of rows, as error bodies of status 200: they
# have none, or they cannot be read.  ``unreadable_pages`` names them in either case.
OnMissing = Literal["none", "fail"]

# A year that is a JSON number with a fraction or an exponent; a year that is a number; the
# character put before a number when it is turned into text.
FRACTION = f'"{TIME}"' + r"\s*:\s*-?[0-9]+[.eE]"
NUMBER = f'("{TIME}"' + r"\s*:\s*)(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)"
MARK = "\ue000"
ROWS_PER_FILE = 1_000_000  # pages of one compressed file


class IncompletePagesError(RuntimeError):
    """Pages are linked that have not been landed."""


def read_landed(
    spark: SparkSession, path: str | list[str], file_format: str = "json", fetched: str | None = None
) -> DataFrame:
    """The landing table: one row per stored response (JSON lines or parquet).

    ``fetched`` names a column for the time at which the file was written, by which ``latest_pages`` can tell
    a page from its repetition.
    """
    pages = spark.read.format(file_format).schema(LANDED).load(path)
    return pages if fetched is None else pages.withColumn(fetched, F.col("_metadata.file_modification_time"))


def latest_pages(landed: DataFrame, order: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One page for each address: the last one by the column ``order``, null first.

    Accepted pages (status 200) go before failed ones, however late; among pages of one time the one with
    the greater hash stays.  Pages without an address are all kept.  Addresses are counted without their
    bodies, and only the pages of repeated addresses are compared.
    """
    good = F.coalesce(F.col("status") == 200, F.lit(False))
    place = F.struct(good.alias("good"), F.col(f"`{order}`").alias("order"), F.xxhash64("code", "status", "body").alias("tie"))
    light = landed.select("url", place.alias("__last")).filter("url is not null")
    counted = light.groupBy("url").agg(F.max("__last").alias("__last"), F.count("*").alias("__pages"))
    repeated = cut_lineage(counted.filter("__pages > 1").drop("__pages"))
    small = measured_bytes(repeated.select("url")) <= broadcast_bytes
    names = [F.col(f"`{c}`") for c in landed.columns]
    urls = repeated.select("url")
    single = landed.join(F.broadcast(urls) if small else urls, "url", "left_anti").select(*names)
    near = landed if small else keep_possible(landed, urls, "url")
    several = join_on_key(near, repeated, "url", small=small)
    # Equal pages landed twice are equal in everything that tells them apart.
    last = several.filter(place.eqNullSafe(F.col("__last"))).dropDuplicates(["url"]).select(*names)
    return single.unionByName(last)


def landed_page_files(
    spark: SparkSession, path: str | list[str], multiline: bool = False, by_code: bool = False
) -> DataFrame:
    """Page files as a landing table: one page per line or (``multiline``) per file.

    Page-per-line files can be split between tasks and should be preferred; their empty
    lines are no pages.  ``by_code`` takes the code from folders named
    ``IndicatorCode=...``, always as text.
    """
    schema = f"value string, {CODE} string" if by_code else "value string"
    lines = spark.read.schema(schema).text(path, wholetext=multiline)
    if not multiline:
        lines = lines.filter(F.trim("value") != "")
    code = F.col(CODE) if by_code else F.lit(None).cast("string")
    url = F.col("_metadata.file_path")
    return lines.select(url.alias("url"), code.alias("code"), F.lit(200).alias("status"), F.col("value").alias("body"))


def write_page_files(pages: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Store the bodies of pages, one per line, in a folder per code.

    The files are compressed, since the bodies repeat their keys, and one of them is read by one task; so
    there are more files where a code has many pages.
    """
    lines = pages.select(F.col("code").alias(CODE), "body")
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", rows_per_file).partitionBy(CODE).text(path)


def read_page_files(
    spark: SparkSession,
    path: str | list[str],
    row: T.StructType,
    on_unreadable: OnUnreadable = "fail",
    multiline: bool = False,
) -> DataFrame:
    """Pages stored as JSON files, decoded as those of a landing table."""
    return decode_pages(landed_page_files(spark, path, multiline), row, on_unreadable=on_unreadable)


def scan_observation_files(
    spark: SparkSession, path: str, on_unreadable: OnUnreadable = "fail", multiline: bool = False
) -> DataFrame:
    """Observations of page files that lie in one folder per requested code.

    A join with a selection leaves the folders of other codes unread.
    """
    return scan_observations(landed_page_files(spark, path, multiline, by_code=True), on_unreadable=on_unreadable)


def keep_ok(landed: DataFrame) -> DataFrame:
    """Leave out failed responses."""
    return landed.filter(F.col("status") == 200)


def fail_on_error(landed: DataFrame) -> DataFrame:
    """Stop the job at the first failed response whose body is read, naming its address."""
    status = F.coalesce(F.col("status").cast("string"), F.lit("without status"))
    problem = data_error("response ", status, " for ", F.coalesce(F.col("url"), F.lit("unknown address")))
    good = F.col("status") == 200
    return landed.withColumn("body", F.when(good, F.col("body")).otherwise(problem.cast("string")))


def refused_pages(landed: DataFrame) -> DataFrame:
    """Address, code and status of the responses at which ``fail_on_error`` stops."""
    names = [c for c in ("url", "code", "status") if c in landed.columns]
    return landed.filter(~F.coalesce(F.col("status") == 200, F.lit(False))).select(*names)


def decode_pages(
    landed: DataFrame,
    row: T.StructType,
    on_error: OnError = "skip",
    on_unreadable: OnUnreadable = "fail",
    on_missing: OnMissing | Column = "fail",
) -> DataFrame:
    """Apply the status policy and parse the bodies; adds ``value`` and the next link.

    An accepted body that is not a page stops the job, or with ``mark`` has no rows and a
    ``problem``; so does a page without rows unless ``on_missing`` is ``none``, or a column that is
    false for the page.
    """
    accepted = {"skip": keep_ok, "fail": fail_on_error}[on_error](landed)
    others = [c for c in landed.columns if c != "body"]
    pages = accepted.withColumn("page", _parsed(row))
    strict = on_missing if isinstance(on_missing, Column) else F.lit({"none": False, "fail": True}[on_missing])
    unreadable = F.col(f"page.{UNREADABLE}").isNotNull()
    problem = F.when(unreadable, "not a page").when(F.col(f"page.{ROWS}").isNull() & strict, "no rows")
    rows, link = F.col(f"page.{ROWS}"), F.col(f"page.`{NEXT_LINK}`").alias(NEXT_LINK)
    if on_unreadable == "mark":
        kept = F.when(problem.isNull(), rows)
        return pages.select(*others, kept.alias(ROWS), link, problem.alias(PROBLEM))
    stop = input_error("unreadable page (", problem, "): ", *_address(landed)).cast(_type_of(pages, ROWS))
    return pages.select(*others, F.when(problem.isNull(), rows).otherwise(stop).alias(ROWS), link)


def _parsed(row: T.StructType) -> Column:
    """The parsed body, years as text.

    Fractions of a number are cut, those of a text are not.  So in the few bodies that have a year
    with a fraction, years that are numbers are marked before the body is parsed.
    """
    body = F.col("body")
    if TIME in row.names:
        marked = F.regexp_replace("body", NUMBER, f'$1"{MARK}$2"')
        body = F.when(body.rlike(FRACTION), marked).otherwise(body)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    return F.from_json(body, page_schema(row), options)


def _address(landed: DataFrame) -> list[Column]:
    names = [c for c in ("url", "code") if c in landed.columns]
    return [F.concat_ws(" ", *names)] if names else []


def _type_of(pages: DataFrame, field: str) -> T.DataType:
    return pages.schema["page"].dataType[field].dataType


def unnest_rows(pages: DataFrame, keep: tuple[str, ...] = (), position: str | None = None) -> DataFrame:
    """One row per entry of ``value``; null and empty arrays give none.

    ``position`` names a column for the place of the entry within its page.  Pages that
    carry a ``problem`` stay as one row; so do rows with a value that is not a number.
    Without that column such a value stops the job.

    The outer form of explode, with the filter after it, parses each body once;
    for the inner form the optimizer adds a filter that parses it again.
    """
    marking = PROBLEM in pages.columns
    keep = (*keep, PROBLEM) if marking else keep
    if position is None:
        rows = pages.select(*keep, F.explode_outer(ROWS).alias("row"))
    else:
        rows = pages.select(*keep, F.posexplode_outer(ROWS).alias(position, "row"))
        keep = (*keep, position)
    held = F.col("row").isNotNull()
    flat = rows.filter(held | F.col(PROBLEM).isNotNull() if marking else held).select(*keep, "row.*")
    if TIME in flat.columns and isinstance(flat.schema[TIME].dataType, T.StringType):
        flat = flat.withColumn(TIME, _year_text(F.col(TIME)))
    if VALUE in flat.columns and isinstance(flat.schema[VALUE].dataType, T.StringType):
        text = F.trim(F.col(VALUE), F.lit('"'))
        number = text.try_cast("double")
        wrong = number.isNull() & F.col(VALUE).isNotNull()
        if marking:
            reason = F.concat(F.lit("not a number: "), F.col(VALUE))
            flat = flat.withColumn(PROBLEM, F.coalesce(PROBLEM, F.when(wrong, reason))).withColumn(VALUE, number)
        else:
            stop = input_error("not a number: ", F.col(VALUE)).cast("double")
            flat = flat.withColumn(VALUE, F.when(wrong, stop).otherwise(number))
    return flat


def _year_text(year: Column) -> Column:
    """A year as text: fractions of marked numbers are cut off, texts stay as they are."""
    number = F.substring(year, 2, 100)
    whole = number.try_cast("double").try_cast("bigint").cast("string")
    return F.when(year.startswith(MARK), F.coalesce(whole, number)).otherwise(year)


def scan_catalog(
    landed: DataFrame,
    on_error: OnError = "fail",
    on_unreadable: OnUnreadable = "fail",
    on_missing: OnMissing | Column = "fail",
) -> DataFrame:
    """Catalogue rows of all landed catalogue pages."""
    return unnest_rows(decode_pages(landed, CATALOG, on_error, on_unreadable, on_missing))


def scan_observations(
    landed: DataFrame,
    on_error: OnError = "skip",
    row: T.StructType = OBSERVATION,
    on_unreadable: OnUnreadable = "fail",
    on_missing: OnMissing | Column = "fail",
) -> DataFrame:
    """Observations of all landed pages, stamped with the code that was asked for.

    With ``mark`` what cannot be read stays as rows with a ``problem``.
    """
    rows = unnest_rows(decode_pages(landed, row, on_error, on_unreadable, on_missing), keep=("code",))
    return stamp_code(rows, "code")


def unreadable_pages(landed: DataFrame, on_error: OnError = "skip", row: T.StructType = OBSERVATION) -> DataFrame:
    """Address, code and problem of every page and every row that cannot be read, and of pages without rows."""
    rows = unnest_rows(decode_pages(landed, row, on_error, "mark"), keep=("url", "code"))
    return rows.filter(F.col(PROBLEM).isNotNull()).select("url", "code", PROBLEM)


def readable_observations(
    landed: DataFrame, on_error: OnError = "skip", row: T.StructType = OBSERVATION
) -> DataFrame:
    """The observations that ``unreadable_pages`` does not name."""
    rows = scan_observations(landed, on_error, row, "mark")
    return rows.filter(F.col(PROBLEM).isNull()).drop(PROBLEM)


def stamp_code(rows: DataFrame, requested: str) -> DataFrame:
    """Replace a payload's indicator code by the requested one."""
    return rows.withColumn(CODE, F.col(requested)).drop(requested)


def page_links(landed: DataFrame, on_error: OnError = "skip") -> DataFrame:
    """Address and next link of the landed pages; rows are not decoded."""
    accepted = {"skip": keep_ok, "fail": fail_on_error}[on_error](landed)
    link = F.from_json("body", T.StructType([T.StructField(NEXT_LINK, T.StringType())]))
    return accepted.select("url", link[NEXT_LINK].alias(NEXT_LINK))


def ensure_complete(landed: DataFrame, on_error: OnError = "skip") -> DataFrame:
    """Return ``landed`` unchanged, or raise if a page is linked that was not landed."""
    missing = [r["missing_url"] for r in audit_page_chain(page_links(landed, on_error)).limit(5).collect()]
    if missing:
        raise IncompletePagesError(f"linked pages were not landed, among them {missing}")
    return landed


def audit_page_chain(pages: DataFrame, link: str = NEXT_LINK) -> DataFrame:
    """Next-page addresses that were never landed, and how many pages name them.

    Links are counted per address before the anti join, so many pages that name
    the same missing address meet as one row.
    """
    links = pages.filter(F.col(f"`{link}`").isNotNull()).groupBy(F.col(f"`{link}`").alias("url"))
    wanted = links.agg(F.count("*").alias("referrers"))
    landed = pages.select("url").filter(F.col("url").isNotNull()).distinct()
    return wanted.join(landed, "url", "left_anti").withColumnRenamed("url", "missing_url")
