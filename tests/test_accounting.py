"""Counts of what a job reads and leaves out, reports of the export, and its number of jobs."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeframe.__main__ import main
from gaugeframe.operators.facts import NoDataError
from gaugeframe.plans.export import TopicCounts, TopicErrors, export_with_report, report_of
from gaugeframe.plans.topics import Topic
from gaugeframe.schemas import CATALOG, LANDED, OBSERVATION
from gaugeframe.sources.accounting import AccountedScan, BadShareError, PageCounts


def page(*rows):
    return json.dumps({"value": [dict(zip(("SpatialDim", "TimeDim", "NumericValue"), r)) for r in rows]})


PAGES = [
    ("1", "A", 200, page(("AND", 2000, 1), ("AND", 2001, "n/a"), ("AND", 2002, None))),
    ("2", "A", 404, page(("lost", 2000, 1))),
    ("3", "B", None, None),
    ("4", "B", 200, '{"error": 1}'),
    ("5", "B", 200, "<html>"),
    ("6", "B", 200, page()),
    ("7", "C", 200, page(("AFG", 2000.7, "2.5"))),
]


def test_counts_of_one_pass(spark, rows):
    scan = AccountedScan(spark.createDataFrame(PAGES, LANDED), on_unreadable="mark")
    assert rows(scan.rows) == [("AFG", "2000", "C", 2.5), ("AND", "2000", "A", 1.0), ("AND", "2002", "A", None)]
    assert scan.counts == PageCounts(pages=7, failed=2, without_rows=1, unreadable=1, rows=3, bad_rows=1)
    assert scan.check(0.6).rows == 3
    with pytest.raises(BadShareError, match="57.14%"):
        scan.check(0.5)


def test_what_stops_a_strict_scan(spark):
    for url, on_missing, message in [("5", "none", "not a page.*5 B"), ("1", "none", "not a number: n/a"), ("4", "fail", "no rows.*4 B")]:
        one = spark.createDataFrame([p for p in PAGES if p[0] == url], LANDED)
        with pytest.raises((PySparkException, Py4JJavaError), match=message):
            AccountedScan(one, on_missing).rows.collect()
    strict = F.col("code") == "A"
    good = spark.createDataFrame([p for p in PAGES if p[0] in "2346"], LANDED)
    assert AccountedScan(good, strict).rows.count() == 0


def test_no_pages(spark):
    scan = AccountedScan(spark.createDataFrame([], LANDED))
    assert scan.rows.count() == 0 and scan.counts.bad_share == 0.0


CATALOG_ROWS = [("A", "red one"), ("B", "red two"), ("C", "blue"), ("D", "blue too"), ("C", "blue again"), ("E", "gone")]
FACTS = [("AND", "2000", "A", 1.0), ("AND", None, "A", 2.0), ("AFG", "1999", "C", None), ("AFG", "1999", "C", 3.0)]
TOPICS = [Topic("red"), Topic("blue", null_policy="value", entity="REGION"), Topic("gone"), Topic("never")]


def test_report_of_an_export(spark, tmp_path):
    catalog, facts = spark.createDataFrame(CATALOG_ROWS, CATALOG), spark.createDataFrame(FACTS, OBSERVATION)
    report = export_with_report(catalog, facts, str(tmp_path / "out"), TOPICS, report_path=str(tmp_path / "report"))
    assert report.topics == {
        "red": TopicCounts(rows=2, kept=1, values=1, codes=1, codes_without_data=1),
        "blue": TopicCounts(rows=4, kept=2, values=2, codes=1, codes_without_data=1),
        "gone": TopicCounts(codes_without_data=1),
        "never": TopicCounts(),
    }
    assert report.without_rows == ["gone", "never"]
    tables = report_of(spark, str(tmp_path / "report"))
    assert [tuple(r) for r in tables["without_data"].collect()] == [("blue", "D"), ("gone", "E"), ("red", "B")]
    assert {r["topic"]: r["rows"] for r in tables["counts"].collect()} == {"red": "2", "blue": "4", "gone": "0", "never": "0"}


def test_nothing_is_published_after_a_failed_check(spark, tmp_path):
    catalog, facts = spark.createDataFrame(CATALOG_ROWS, CATALOG), spark.createDataFrame(FACTS, OBSERVATION)

    def refuse():
        raise BadShareError("too much")

    with pytest.raises(BadShareError):
        export_with_report(catalog, facts, str(tmp_path / "out"), TOPICS, check=refuse)
    assert not list(tmp_path.glob("out/*"))


def test_order_of_lines_in_large_files(spark, tmp_path):
    """Many parts: read in part order they are the files, each topic with its own columns."""
    catalog = spark.createDataFrame([(c, f"{t} name") for c, t in (("A", "red"), ("B", "red"), ("C", "blue"))], CATALOG)
    ids = spark.range(6000)
    facts = ids.select(
        F.format_string("E%04d", F.col("id") % 1500).alias("SpatialDim"), (2000 + F.floor(F.col("id") / 1500)).cast("string").alias("TimeDim"),
        F.element_at(F.array(*map(F.lit, "ABC")), (F.col("id") % 3 + 1).cast("int")).alias("IndicatorCode"), (F.col("id") / 2).alias("NumericValue"),
    )
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        export_with_report(catalog, facts, str(tmp_path), [Topic("red"), Topic("blue", entity="PLACE")])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for topic, entity, codes in (("red", "COUNTRY", "AB"), ("blue", "PLACE", "C")):
        parts = sorted((tmp_path / topic / "wide").glob("part-*"))
        lines = "".join(p.read_text() for p in parts).splitlines()
        assert len(parts) > 1 or topic == "blue"
        assert lines[0] == "IndicatorCode," + ",".join(c for c in codes for _ in range(4))
        assert lines[2] == entity + "," * 4 * len(codes)
        own = [r for r in facts.collect() if r["IndicatorCode"] in codes]
        expected = {}
        for r in own:
            expected.setdefault(r["SpatialDim"], {})[r["IndicatorCode"], int(r["TimeDim"])] = r["NumericValue"]
        columns = [(c, y) for c in codes for y in range(2000, 2004)]
        assert lines[3:] == [",".join([e, *(str(expected[e].get(k, "")) for k in columns)]) for e in sorted(expected)]


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_number_of_jobs_does_not_grow_with_the_topics(spark, tmp_path):
    catalog = spark.createDataFrame([(f"C{i}", f"name {i:03}") for i in range(40)], CATALOG)
    facts = spark.createDataFrame([("AND", "2000", f"C{i}", 1.0) for i in range(40)], OBSERVATION)
    few, many = ([Topic(f"name_{i:03}") for i in range(n)] for n in (2, 40))
    count = {len(t): jobs_of(spark, f"export {len(t)}", lambda: export_with_report(catalog, facts, str(tmp_path / str(len(t))), t)) for t in (few, many)}
    assert count[40] <= count[2] + 2, count
    assert len(list((tmp_path / "40").glob("*/wide"))) == 40


def test_bad_topic_and_no_topic(spark, tmp_path):
    catalog = spark.createDataFrame(CATALOG_ROWS, CATALOG)
    facts = spark.createDataFrame([("AND", "20x", "A", 1.0), ("AND", "2000", "C", 1.0)], OBSERVATION)
    with pytest.raises(TopicErrors, match="red: not a year: 20x"):
        export_with_report(catalog, facts, str(tmp_path / "a"), TOPICS)
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["blue"]
    with pytest.raises(NoDataError):
        export_with_report(catalog, facts.limit(0), str(tmp_path / "b"), TOPICS)


def test_command_line_counts_and_limits(spark, tmp_path, capsys):
    catalog = json.dumps({"value": [{"IndicatorCode": c, "IndicatorName": "HIV"} for c in "ABCD"]})
    spark.createDataFrame([("c", None, 200, catalog)], LANDED).write.parquet(f"{tmp_path}/catalog")
    spark.createDataFrame(PAGES, LANDED).write.parquet(f"{tmp_path}/facts")
    args = ["--catalog", f"{tmp_path}/catalog", "--observations", f"{tmp_path}/facts", "--format", "parquet", "--topic", "hiv"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        main([*args, "--output", f"{tmp_path}/a"])
    with pytest.raises(BadShareError):
        main([*args, "--output", f"{tmp_path}/a", "--max-bad-share", "0.1"])
    with pytest.raises((PySparkException, Py4JJavaError), match="no rows"):
        main([*args, "--output", f"{tmp_path}/a", "--max-bad-share", "0.9", "--on-missing", "fail"])
    assert not list(tmp_path.glob("a/*"))
    main([*args, "--output", f"{tmp_path}/a", "--max-bad-share", "0.6", "--report", f"{tmp_path}/report"])
    assert "pages=7, failed=2, without_rows=1, unreadable=1, rows=3, bad_rows=1" in capsys.readouterr().out
    assert [r["IndicatorCode"] for r in report_of(spark, f"{tmp_path}/report")["without_data"].collect()] == ["B", "D"]
