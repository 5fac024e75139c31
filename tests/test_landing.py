import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeframe.operators.facts import observations_for
from gaugeframe.operators.selection import select_indicators
from gaugeframe.schemas import CATALOG, LANDED, NEXT_LINK, OBSERVATION
from gaugeframe.sources.landing import (
    audit_page_chain,
    decode_pages,
    ensure_complete,
    fail_on_error,
    IncompletePagesError,
    keep_ok,
    landed_page_files,
    read_page_files,
    readable_observations,
    scan_catalog,
    scan_observation_files,
    scan_observations,
    unnest_rows,
    unreadable_pages,
    write_page_files,
)


def landed(spark, *records):
    return spark.createDataFrame(list(records), LANDED)


def page(*rows, link=None):
    body = {"value": list(rows)}
    if link:
        body[NEXT_LINK] = link
    return json.dumps(body)


def test_catalog_pages_are_unnested(spark, rows):
    pages = landed(
        spark,
        ("u1", None, 200, page({"IndicatorCode": "A", "IndicatorName": "a", "Language": "EN"}, {"IndicatorCode": "B"})),
        ("u2", None, 200, page()),
    )
    assert rows(scan_catalog(pages)) == [("A", "a"), ("B", None)]
    for body in ('{"other": 1}', '{"value": null}', None):
        with pytest.raises(PySparkException, match="no rows"):
            scan_catalog(pages.union(landed(spark, ("u3", None, 200, body)))).collect()


def test_requested_code_replaces_the_payload_code(spark, rows):
    row = {"SpatialDim": "AFG", "TimeDim": 2016, "IndicatorCode": "payload", "NumericValue": 1.5}
    pages = landed(spark, ("u", "ASKED", 200, page(row, {"SpatialDim": "ALB", "TimeDim": None})))
    found = rows(scan_observations(pages), "SpatialDim", "TimeDim", "IndicatorCode", "NumericValue")
    assert found == [("AFG", "2016", "ASKED", 1.5), ("ALB", None, "ASKED", None)]


def test_failed_responses_are_skipped_or_stop_the_job(spark, rows):
    pages = landed(
        spark,
        ("good", "A", 200, page({"SpatialDim": "AFG", "TimeDim": 2000, "NumericValue": 1})),
        ("bad", "B", 404, page({"SpatialDim": "ALB", "TimeDim": 2000, "NumericValue": 2})),
        ("none", "C", None, None),
    )
    assert rows(keep_ok(pages), "url") == [("good",)]
    assert rows(scan_observations(pages), "SpatialDim") == [("AFG",)]
    with pytest.raises(PySparkException, match="response (404 for bad|without status for none)"):
        scan_observations(pages, on_error="fail").collect()
    with pytest.raises(PySparkException):
        fail_on_error(pages).select("body").collect()


BAD = [
    ("html", "<html>not json", "not a page"),
    ("cut", '{"value": [{"SpatialDim": "AFG"}, {"Spa', "not a page"),
    ("object", '{"value": {"SpatialDim": "AFG"}}', "not a page"),
    ("list", "[1, 2]", "not a page"),
    ("other", '{"error": 1}', "no rows"),
    ("text", page({"SpatialDim": "AFG", "NumericValue": 1}, {"NumericValue": "n/a"}, {"SpatialDim": "ALB", "NumericValue": "2.5"}), "not a number: n/a"),
]


def test_unreadable_pages_stop_the_job_or_are_named(spark, rows):
    good = ("good", "A", 200, page({"SpatialDim": "AND", "TimeDim": 2000, "NumericValue": 3}))
    pages = landed(spark, good, ("failed", "A", 500, "oops"), *[(u, "A", 200, b) for u, b, _ in BAD])
    assert rows(unreadable_pages(pages)) == sorted((u, "A", p) for u, _, p in BAD)
    assert rows(readable_observations(pages), "SpatialDim", "NumericValue") == [("AFG", 1.0), ("ALB", 2.5), ("AND", 3.0)]
    for u, body, problem in BAD:
        with pytest.raises((PySparkException, Py4JJavaError), match=problem):
            scan_observations(landed(spark, good, (u, "A", 200, body))).collect()


def test_files_and_table_give_the_same(spark, rows, tmp_path):
    bodies = [b for _, b, _ in BAD] + [page({"SpatialDim": "AND", "TimeDim": 2000.9, "NumericValue": 3})]
    (tmp_path / "pages.json").write_text("\n\n".join(bodies))
    table = landed(spark, *[("u", None, 200, b) for b in bodies])
    files = landed_page_files(spark, str(tmp_path))
    for read in (readable_observations, lambda x: unreadable_pages(x).select("problem")):
        assert rows(read(files)) == rows(read(table))


def test_years_of_json(spark, rows):
    years = [2016, 2016.0, 2016.7, 2.016e3, "2016", "2016.7", None]
    pages = landed(spark, ("u", "A", 200, page(*[{"SpatialDim": str(i), "TimeDim": y} for i, y in enumerate(years)])))
    found = [r["TimeDim"] for r in scan_observations(pages).orderBy("SpatialDim").collect()]
    assert found == ["2016", "2016", "2016", "2016", "2016", "2016.7", None]


def test_positions_within_pages(spark, rows):
    pages = landed(spark, ("u", None, 200, page({"IndicatorCode": "B"}, {"IndicatorCode": "A"})))
    found = unnest_rows(decode_pages(pages, CATALOG), keep=("url",), position="place")
    assert rows(found, "url", "place", "IndicatorCode") == [("u", 0, "B"), ("u", 1, "A")]


def test_page_files(spark, rows, tmp_path):
    (tmp_path / "pages.json").write_text(page({"SpatialDim": "AFG", "NumericValue": 2}) + "\n" + page())
    found = unnest_rows(read_page_files(spark, str(tmp_path), OBSERVATION), keep=("url",))
    assert rows(found, "SpatialDim", "NumericValue") == [("AFG", 2.0)]
    assert found.select("url").first()["url"].endswith("pages.json")


def test_one_page_per_file(spark, rows, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"value": [{"IndicatorCode": f"C{i}"}]}, indent=1))
    found = unnest_rows(read_page_files(spark, str(tmp_path), CATALOG, multiline=True))
    assert rows(found, "IndicatorCode") == [("C0",), ("C1",), ("C2",)]


def test_chain_audit_names_missing_pages(spark, rows):
    pages = spark.createDataFrame(
        [("p1", "p2"), ("p2", "p3"), ("p4", "p9"), ("p5", "p9"), ("p6", None), (None, "p1")],
        f"url string, `{NEXT_LINK}` string",
    )
    assert rows(audit_page_chain(pages)) == [("p3", 1), ("p9", 2)]


def test_complete_chain_is_required(spark):
    pages = landed(spark, ("p1", None, 200, page(link="p2")), ("p2", None, 200, page()))
    assert ensure_complete(pages) is pages
    with pytest.raises(IncompletePagesError, match="p2"):
        ensure_complete(pages.filter("url = 'p1'"))


def test_bodies_are_parsed_once(spark):
    pages = landed(spark, ("u", "A", 200, page()))
    plan = scan_observations(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_a_link_under_another_name_is_not_followed(spark):
    body = json.dumps({"value": [], "@data.nextLink": "p2"})
    decoded = decode_pages(landed(spark, ("p1", None, 200, body)), CATALOG)
    assert decoded.filter(F.col(f"`{NEXT_LINK}`").isNotNull()).count() == 0


def test_page_files_in_code_folders(spark, rows, tmp_path):
    for code, value in (("007", 1), ("8", 2), ("9", 3)):
        folder = tmp_path / f"IndicatorCode={code}"
        folder.mkdir()
        (folder / "p.json").write_text(page({"SpatialDim": "AFG", "TimeDim": 2000, "IndicatorCode": "payload", "NumericValue": value}))
    found = scan_observation_files(spark, str(tmp_path))
    assert rows(found, "IndicatorCode", "TimeDim", "NumericValue") == [("007", "2000", 1.0), ("8", "2000", 2.0), ("9", "2000", 3.0)]
    names = spark.createDataFrame([("007", "agent"), ("8", "other")], CATALOG)
    chosen = observations_for(found, select_indicators(names, ["age"]))
    assert rows(chosen, "IndicatorCode", "NumericValue") == [("007", 1.0)]
    assert "dynamicpruning" in chosen._jdf.queryExecution().executedPlan().toString().lower()


def test_stored_page_files_are_compressed_and_bounded(spark, rows, tmp_path):
    body = F.concat(F.lit('{"value":[{"SpatialDim":"AFG","TimeDim":2000,"NumericValue":'), F.col("id"), F.lit("}]}"))
    pages = spark.range(0, 3000, 1, 2).select((F.col("id") % 2).cast("string").alias("code"), body.alias("body"))
    write_page_files(pages, str(tmp_path / "pages"), rows_per_file=400)
    files = list((tmp_path / "pages").rglob("part-*"))
    assert len(files) == 8 and sum(f.stat().st_size for f in files) < 3000 * 60 / 4
    found = rows(scan_observation_files(spark, str(tmp_path / "pages")), "IndicatorCode", "NumericValue")
    assert found == sorted((str(i % 2), float(i)) for i in range(3000))
