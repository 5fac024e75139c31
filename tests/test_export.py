import json
from pathlib import Path

import pytest

from pyspark.errors import PySparkException

from gaugeframe.__main__ import main
from gaugeframe.operators.facts import NoDataError
from gaugeframe.plans.export import TopicErrors, export_topics
from gaugeframe.plans.topics import topic_named
from gaugeframe.schemas import CATALOG, OBSERVATION
from gaugeframe.sources.landing import IncompletePagesError


def text_of(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_from_landed_pages_to_files(spark, tmp_path):
    catalog = [{"IndicatorCode": "H1", "IndicatorName": "HIV deaths"}, {"IndicatorCode": "S1", "IndicatorName": "AMR systems"}]
    facts = {
        "H1": [("AFG", 2001, 2), ("AFG", 2001, 3), ("ALB", 2000, 1e8), ("ZWE", 2000, None)],
        "S1": [("AFR", 2018, 4.5)],
        "Q1": [("AFG", 2001, 7)],
    }
    (tmp_path / "catalog").mkdir()
    (tmp_path / "facts").mkdir()
    page = {"url": "c", "code": None, "status": 200, "body": json.dumps({"value": catalog})}
    (tmp_path / "catalog" / "p.json").write_text(json.dumps(page))
    lines = [
        {
            "url": code,
            "code": code,
            "status": 200,
            "body": json.dumps({"value": [dict(zip(("SpatialDim", "TimeDim", "NumericValue"), r)) for r in rows]}),
        }
        for code, rows in facts.items()
    ]
    lines.append({"url": "x", "code": "H1", "status": 500, "body": "down"})
    (tmp_path / "facts" / "p.json").write_text("\n".join(map(json.dumps, lines)))
    main(["--catalog", str(tmp_path / "catalog"), "--observations", str(tmp_path / "facts"), "--output", str(tmp_path / "out")])
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"antimicrobial_resistance", "health_statistics", "hiv"}
    assert text_of(tmp_path / "out" / "hiv" / "wide") == (
        "IndicatorCode,H1,H1\nYEAR,2000,2001\nCOUNTRY,,\nAFG,,2.5\nALB,100000000.0,\n"
    )
    long = text_of(tmp_path / "out" / "hiv" / "long").splitlines()
    assert long[0] == "COUNTRY,YEAR,IndicatorCode,NumericValue"
    assert sorted(x for x in long if x != long[0]) == ["AFG,2001,H1,2.0", "AFG,2001,H1,3.0", "ALB,2000,H1,100000000.0", "ZWE,2000,H1,"]
    assert text_of(tmp_path / "out" / "antimicrobial_resistance" / "long").startswith("REGION,YEAR,")


def test_topics_without_data_are_named_and_none_at_all_is_an_error(spark, tmp_path):
    catalog = spark.createDataFrame([("H1", "HIV"), ("M1", "malaria")], CATALOG)
    facts = spark.createDataFrame([("AFG", "2000", "H1", None)], OBSERVATION)
    topics = [topic_named("hiv"), topic_named("malaria")]
    assert export_topics(catalog, facts, str(tmp_path / "out"), topics) == ["malaria"]
    assert [p.name for p in (tmp_path / "out" / "hiv").iterdir()] == ["long"]
    with pytest.raises(NoDataError):
        export_topics(catalog, facts, str(tmp_path / "none"), topics[1:])


def test_bad_data_of_one_topic_do_not_stop_the_others(spark, tmp_path):
    catalog = spark.createDataFrame([("H1", "HIV"), ("M1", "malaria"), ("S1", "AMR")], CATALOG)
    facts = spark.createDataFrame(
        [("AFG", "2000", "H1", 1.0), ("AFG", "2000-2005", "M1", 1.0), ("AFR", None, "S1", 1.0)], OBSERVATION
    )
    topics = [topic_named("malaria"), topic_named("antimicrobial_resistance"), topic_named("hiv")]
    with pytest.raises(TopicErrors, match="malaria: .*not a year.*antimicrobial_resistance: .*without a year") as found:
        export_topics(catalog, facts, str(tmp_path / "out"), topics)
    assert list(found.value.problems) == ["malaria", "antimicrobial_resistance"]
    assert text_of(tmp_path / "out" / "hiv" / "wide").endswith("AFG,1.0\n")


def test_no_stale_files_and_no_scratch_are_left(spark, tmp_path):
    catalog = spark.createDataFrame([("H1", "HIV"), ("M1", "malaria")], CATALOG)
    topics = [topic_named("hiv"), topic_named("malaria")]
    full = spark.createDataFrame([("AFG", "2000", "H1", 1.0), ("AFG", "2000", "M1", 1.0)], OBSERVATION)
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    export_topics(catalog, full, str(tmp_path / "out"), topics)
    assert (tmp_path / "out" / "hiv" / "wide").exists() and (tmp_path / "out" / "malaria" / "long").exists()
    empty = spark.createDataFrame([("AFG", "2000", "H1", None)], OBSERVATION)
    assert export_topics(catalog, empty, str(tmp_path / "out"), topics) == ["malaria"]
    assert [p.name for p in (tmp_path / "out").glob("*/*")] == ["long"]
    assert not list(shared.glob("topics-*"))


def test_failed_or_missing_catalog_pages_stop_the_export(spark, tmp_path):
    good = {"url": "c1", "code": None, "status": 200, "body": json.dumps({"value": [{"IndicatorCode": "H1", "IndicatorName": "HIV"}], "@odata.nextLink": "c2"})}
    fact = {"url": "f", "code": "H1", "status": 200, "body": json.dumps({"value": [{"SpatialDim": "AFG", "TimeDim": 2000, "NumericValue": 1}]})}
    (tmp_path / "facts").mkdir()
    (tmp_path / "facts" / "p.json").write_text(json.dumps(fact))
    (tmp_path / "catalog").mkdir()
    args = ["--catalog", str(tmp_path / "catalog"), "--observations", str(tmp_path / "facts"), "--output", str(tmp_path / "out"), "--topic", "hiv"]
    (tmp_path / "catalog" / "p.json").write_text(json.dumps(good))
    with pytest.raises(IncompletePagesError, match="c2"):
        main(args)
    bad = {"url": "c2", "code": None, "status": 503, "body": "busy"}
    (tmp_path / "catalog" / "p.json").write_text(json.dumps(good) + "\n" + json.dumps(bad))
    with pytest.raises(PySparkException, match="response 503 for c2"):
        main(args)
    main([*args, "--catalog-on-error", "skip", "--allow-missing-pages"])
    assert (tmp_path / "out" / "hiv" / "wide").exists()
