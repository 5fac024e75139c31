"""Jobs that end in files: long and wide CSV of one topic, or of all topics from one scan."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.functions.numbers import float_text, mean_of, whole_year
from gaugeframe.operators.facts import NoDataError
from gaugeframe.operators.means import exact_means
from gaugeframe.operators.reshape import mark_missing, mean_cells, rename
from gaugeframe.operators.selection import select_by_topic
from gaugeframe.plans.topics import ENTITY, TOPICS, Topic, all_topics_rows
from gaugeframe.schemas import CODE, VALUE, YEAR
from gaugeframe.sinks.csv import CSV_FORMAT, wide_csv_lines_by_topic, write_long_csv, write_wide_csv
from gaugeframe.storage import cut_lineage, move_path, remove_path, scratch_path


class TopicErrors(RuntimeError):
    """Topics that could not be exported, with the reason of each."""

    def __init__(self, problems: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {str(error).splitlines()[0]}" for name, error in problems.items()))
        self.problems = problems


class TopicDataError(ValueError):
    """Bad data of one topic."""


@dataclass(frozen=True)
class TopicCounts:
    """Rows of one topic: collected, kept by its null policy, with a value; codes with and without rows."""

    rows: int = 0
    kept: int = 0
    values: int = 0
    codes: int = 0
    codes_without_data: int = 0


@dataclass(frozen=True)
class ExportReport:
    """Counts of every topic, and the topics that had no rows."""

    topics: dict[str, TopicCounts] = field(default_factory=dict)

    @property
    def without_rows(self) -> list[str]:
        return [name for name, counts in self.topics.items() if not counts.rows]


def export_tables(long: DataFrame, entity: str, path: str, scale: int | None = None) -> None:
    """Write ``path/long`` and ``path/wide`` from a stored long table.

    A table without any value, and so without wide columns, has no wide file.
    """
    write_long_csv(long, f"{path}/long")
    write_wide_csv(mean_cells(long, entity, scale), f"{path}/wide", entity)


def marked_long(rows: DataFrame, topics: Sequence[Topic]) -> DataFrame:
    """Long tables of all topics, marked by the number of the topic; nothing stops at bad data.

    ``kept`` says whether the null policy of the topic keeps the row, ``problem`` why the topic cannot be
    exported if it does.
    """
    renamed = rename(mark_missing(rows), ENTITY)
    year = F.col(YEAR) if isinstance(renamed.schema[YEAR].dataType, T.IntegerType) else whole_year(F.col(YEAR), lenient=True)
    by_value = F.col("topic").isin([t.name for t in topics if t.null_policy == "value"])
    has_keys = F.col(ENTITY).isNotNull() & F.col(YEAR).isNotNull() & F.col(CODE).isNotNull()
    kept = F.when(by_value, F.col(VALUE).isNotNull()).otherwise(has_keys)
    problem = F.when(F.col(YEAR).isNull(), "observation with a value but without a year").when(
        year.isNull(), F.concat(F.lit("not a year: "), F.col(YEAR).cast("string"))
    )
    numbers = F.create_map(*[F.lit(x) for i, t in enumerate(topics) for x in (t.name, i)])
    return renamed.select(
        F.element_at(numbers, F.col("topic")).alias("topic"),
        F.col(ENTITY).alias("entity"),
        year.alias(YEAR),
        CODE,
        VALUE,
        kept.alias("kept"),
        F.when(kept, problem).alias("problem"),
    )


def export_topics(
    catalog: DataFrame,
    observations: DataFrame,
    path: str,
    topics: Sequence[Topic] = TOPICS,
    dedupe: bool = False,
    scale: int | None = None,
) -> list[str]:
    """``export_with_report`` for callers that only need the topics without data."""
    return export_with_report(catalog, observations, path, topics, dedupe, scale).without_rows


def export_with_report(
    catalog: DataFrame,
    observations: DataFrame,
    path: str,
    topics: Sequence[Topic] = TOPICS,
    dedupe: bool = False,
    scale: int | None = None,
    exact: bool = False,
    report_path: str | None = None,
    check: Callable[[], object] | None = None,
) -> ExportReport:
    """Write ``path/<topic>/long`` and ``.../wide`` for every topic that has data.

    The observations are scanned once.  Their selected rows, cleaned under the policy of their topic,
    are stored in one folder per topic; the long files come from these without another shuffle, the
    wide files of all topics from one job over their means.  The number of jobs does not depend on
    the number of topics.  ``check`` is called after the scan, before any file is published, and may raise.

    Bad data of one topic do not keep the others from being exported; they are raised as
    ``TopicErrors`` in the end.  If no topic has any rows, that is an error.  ``report_path`` gets the
    tables ``counts`` and ``without_data`` (topic, code) as CSV.
    """
    spark = catalog.sparkSession
    # Files of an earlier export must not stand beside those of this one.
    for topic in topics:
        remove_path(spark, f"{path}/{topic.name}")
    stored_path, staged = scratch_path(spark, "topics"), f"{path}/_export-{uuid.uuid4().hex}"
    try:
        rows = marked_long(all_topics_rows(catalog, observations, topics, dedupe), topics)
        rows.hint("rebalance", "topic").write.partitionBy("topic").parquet(stored_path)
        if check is not None:
            check()
        stored = spark.read.schema(rows.schema).parquet(stored_path)
        report, problems = _counted(catalog, stored, topics, report_path)
        good = [i for i, t in enumerate(topics) if report.topics[t.name].rows and t.name not in problems]
        kept = stored.filter(F.col("topic").isin(good) & F.col("kept"))
        _write_long(kept, topics, good, staged)
        _write_wide(kept, topics, good, staged, scale, exact)
        for i in good:
            target = f"{path}/{topics[i].name}"
            if not move_path(spark, f"{staged}/{_long_folder(topics, i)}/topic={i}", f"{target}/long"):
                # All rows were dropped: a folder without rows says that there was data.
                write_long_csv(_renamed(kept.limit(0), topics[i].entity), f"{target}/long")
            move_path(spark, f"{staged}/wide/topic={i}", f"{target}/wide")
    finally:
        remove_path(spark, stored_path)
        remove_path(spark, staged)
    if problems:
        raise TopicErrors({name: TopicDataError(text) for name, text in problems.items()})
    if len(report.without_rows) == len(topics):
        raise NoDataError("no observations collected for any topic")
    return report


def _counted(
    catalog: DataFrame, stored: DataFrame, topics: Sequence[Topic], report_path: str | None
) -> tuple[ExportReport, dict[str, str]]:
    """Counts and problems per topic, from the stored rows and the selection."""
    spark = stored.sparkSession
    found = stored.groupBy("topic").agg(
        F.count("*").alias("rows"),
        F.count_if("kept").alias("kept"),
        F.count_if(F.col("kept") & F.col(VALUE).isNotNull()).alias("values"),
        F.min("problem").alias("problem"),
    )
    # One row per topic each.
    by_topic = {topics[r["topic"]].name: r for r in found.collect()}
    numbers = spark.createDataFrame([(t.name, i) for i, t in enumerate(topics)], "name string, topic int")
    selected = select_by_topic(catalog, {t.name: t.patterns for t in topics}, names=False).withColumnRenamed("topic", "name")
    selected = selected.join(F.broadcast(numbers), "name").select("name", "topic", CODE)
    held = stored.select("topic", CODE).distinct().withColumn("held", F.lit(True))
    status = selected.join(held, ["topic", CODE], "left")
    if report_path is not None:
        status = cut_lineage(status)
    shares = status.groupBy("name").agg(F.count("held").alias("with"), F.count_if(F.col("held").isNull()).alias("without"))
    codes = {r["name"]: (r["with"], r["without"]) for r in shares.collect()}
    counts = {}
    for topic in topics:
        row, (had, lacks) = by_topic.get(topic.name), codes.get(topic.name, (0, 0))
        counts[topic.name] = TopicCounts(row["rows"], row["kept"], row["values"], had, lacks) if row else TopicCounts(0, 0, 0, had, lacks)
    if report_path is not None:
        listed = [(name, *vars(c).values()) for name, c in counts.items()]
        schema = "topic string, rows long, kept long, values long, codes long, codes_without_data long"
        options = {"header": True, **CSV_FORMAT}
        spark.createDataFrame(listed, schema).coalesce(1).write.mode("overwrite").options(**options).csv(f"{report_path}/counts")
        listed = status.filter("held is null").select(F.col("name").alias("topic"), CODE)
        listed.orderBy("topic", CODE).write.mode("overwrite").options(**options).csv(f"{report_path}/without_data")
    problems = {t.name: by_topic[t.name]["problem"] for t in topics if t.name in by_topic and by_topic[t.name]["problem"]}
    return ExportReport(counts), problems


def _entities(topics: Sequence[Topic]) -> list[str]:
    return sorted({t.entity for t in topics})


def _long_folder(topics: Sequence[Topic], number: int) -> str:
    return f"long-{_entities(topics).index(topics[number].entity)}"


def _renamed(rows: DataFrame, entity: str) -> DataFrame:
    return rows.select(F.col("entity").alias(entity), YEAR, CODE, VALUE)


def _write_long(kept: DataFrame, topics: Sequence[Topic], good: Sequence[int], staged: str) -> None:
    """The long files: one job per name of the entity column, as it stands in the header."""
    for entity in _entities([topics[i] for i in good]):
        own = [i for i in good if topics[i].entity == entity]
        rows = kept.filter(F.col("topic").isin(own)).select(
            "topic", F.col("entity").alias(entity), YEAR, CODE, float_text(F.col(VALUE)).alias(VALUE)
        )
        folder = f"{staged}/{_long_folder(topics, own[0])}"
        rows.write.partitionBy("topic").options(header=True, **CSV_FORMAT).csv(folder)


def _write_wide(
    kept: DataFrame, topics: Sequence[Topic], good: Sequence[int], staged: str, scale: int | None, exact: bool
) -> None:
    """The wide files of all topics."""
    present = kept.dropna(subset=["entity", CODE, YEAR, VALUE])
    keys = ["topic", "entity", CODE, YEAR]
    if exact:
        cells = exact_means(present, keys, VALUE)
    else:
        cells = present.groupBy(*keys).agg(mean_of(F.col(VALUE), scale).alias(VALUE))
    cells = cut_lineage(cells)
    if not good or cells.isEmpty():
        return
    lines = wide_csv_lines_by_topic(cells, {i: topics[i].entity for i in good})
    lines.select("topic", "line").write.partitionBy("topic").text(f"{staged}/wide")


def report_of(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that ``report_path`` got."""
    return {name: spark.read.option("header", True).csv(f"{path}/{name}") for name in ("counts", "without_data")}
