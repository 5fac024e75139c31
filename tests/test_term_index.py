"""Terms looked up by grams: literals of patterns, the stored index, topics as a table."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeframe.functions.grams import grams, grams_of, required_literals
from gaugeframe.functions.matching import terms_together
from gaugeframe.operators.selection import select_by_topic, select_by_topic_table, select_indicators, topic_classes
from gaugeframe.sources.term_index import candidates, find_terms, write_term_index

CATALOG = "IndicatorCode string, IndicatorName string"


@pytest.mark.parametrize(
    "term, literals",
    [
        ("HIV", ["hiv"]),
        ("deaths (female)", ["deaths "]),
        ("plans?|planned+", ["plan", "planned"]),
        ("a{2}bcd", ["bcd"]),
        ("ab*cde*", ["cd"][:0] or None),
        (r"one\.two three", ["two three"]),
        ("[abc]lmn(x|y)opq", ["lmn"]),
        ("no|yes", None),
        ("öre", None),
        ("wörter", ["rter"]),
        ("(?i)abc", None),
        (r"\Qa|b\E", None),
        ("(abc|def)", None),
        (".*", None),
    ],
)
def test_literals_of_terms(term, literals):
    assert required_literals(term) == literals


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abc?*+|()[].^ "), min_size=1, max_size=12), st.text(alphabet="abc ", max_size=25))
def test_every_match_has_a_literal(term, name):
    try:
        met = re.search(term, name)
    except re.error:
        return
    literals = required_literals(term)
    assert not (met and literals) or any(x in name for x in literals)


def test_grams(spark):
    frame = spark.createDataFrame([("abcab",), ("ab",), ("",), (None,), ("aé😀bcd",)], "x string")
    found = [r[0] and sorted(r[0]) for r in frame.select(grams(F.col("x"))).collect()]
    assert found == [["abc", "bca", "cab"], [], [], None, ["bcd"]]
    assert grams_of("abcab") == ["abc", "bca", "cab"]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="ab(", min_size=1, max_size=5), min_size=1, max_size=8), st.text(alphabet="ab(", max_size=30))
def test_terms_found_together(terms, name):
    met = {m.group(1) for m in re.finditer(terms_together(terms), name)}
    longest = {max((t for t in terms if name.startswith(t, i)), key=len, default=None) for i in range(len(name))} - {None}
    assert met == longest
    assert {t for t in terms if any(t in m for m in met)} == {t for t in terms if t in name}


@pytest.fixture(scope="module")
def catalog(spark):
    rng = random.Random(2)
    words = ["red", "ring", "rings", "Bolt", "HIV", "tests", "(s)", "öre", "été", "x", "ab", "KK"]
    names = [" ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(600)]
    rows = [(str(i % 400), n) for i, n in enumerate(names)] + [("1", None), (None, "red ring"), ("7", "needle in the hay"), ("7", "needle in the hay")]
    return spark.createDataFrame(rows, CATALOG)


LISTS = [["ring"], ["HIV tests", "bolt"], ["öre|RED r"], ["x"], ["needle"], ["absent term"], ["rings? (red|x)", "ab", "kk"]]


def test_index_finds_what_a_scan_finds(spark, rows, catalog, tmp_path):
    write_term_index(catalog, str(tmp_path), folders=16)
    for terms in LISTS:
        want = rows(select_indicators(catalog, terms))
        assert rows(find_terms(spark, str(tmp_path), terms)) == want
        assert rows(find_terms(spark, str(tmp_path), terms, broadcast_bytes=0)) == want
    for terms in ([], [""]):
        with pytest.raises(ValueError):
            find_terms(spark, str(tmp_path), terms)


def test_look_ups_read_little(spark, catalog, tmp_path):
    """Only the folder of the one name with a rare term is read, and only postings of chosen grams."""
    write_term_index(catalog, str(tmp_path), folders=16)
    assert candidates(spark, str(tmp_path), ["needle in"]).count() == 1
    found = find_terms(spark, str(tmp_path), ["needle in"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    scans = plan.toString()
    assert "dynamicpruning" in scans.lower()
    files = [int(n) for n in re.findall(r"numFiles=(\d+)", metrics(plan))]
    assert files == [1]
    postings = candidates(spark, str(tmp_path), ["needle in"])._jdf.queryExecution().executedPlan().toString()
    assert "In(gram" in postings


def metrics(plan) -> str:
    """``numFiles`` of all file scans of a plan that has run."""
    text, queue = [], [plan]
    while queue:
        node = queue.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        found = node.metrics().get("numFiles")
        if found.isDefined() and "names" in node.toString():
            text.append(f"numFiles={found.get().value()}")
        for child in (node.children(), node.subqueries()):
            queue += [child.apply(i) for i in range(child.length())]
        if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            queue.append(node.plan())
    return " ".join(text)


def test_index_of_nothing(spark, catalog, tmp_path):
    write_term_index(catalog.limit(0), str(tmp_path))
    assert find_terms(spark, str(tmp_path), ["ring", "x"]).count() == 0


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 25])
def test_topics_as_a_table(spark, rows, catalog, broadcast_bytes):
    patterns = {f"t{i}": terms for i, terms in enumerate(LISTS)}
    table = spark.createDataFrame([(t, x) for t, terms in patterns.items() for x in [*terms, terms[0]]] + [(None, "ring"), ("t0", None)], "topic string, term string")
    for names in (True, False):
        want = rows(select_by_topic(catalog, patterns, names))
        assert rows(select_by_topic_table(catalog, table, names, broadcast_bytes)) == want
    assert select_by_topic_table(catalog.limit(0), table).count() == 0
    assert select_by_topic_table(catalog, table.limit(0)).count() == 0
    with pytest.raises(ValueError, match="more than 2 terms"):
        select_by_topic_table(catalog, table, most_patterns=2)


def test_many_terms_of_many_topics(spark, rows, catalog):
    """Terms within terms, shared by topics, searched together: as searched one by one."""
    terms = ["r", "re", "red", "red r", "ring", "rings", "ing", "HIV", "hiv tests", "IV t", "t", "ab", "(", "(s)", "b b", "x red", "bolt"]
    patterns = {f"one {t}": [t.replace("(", r"\(").replace(")", r"\)")] for t in terms} | {"all": ["rings", "ab", "öre"], "two": ["HIV", "x red"]}
    found = rows(select_by_topic(catalog, patterns))
    assert found == sorted(
        {(t, r[0], r[1]) for t, p in patterns.items() for r in select_indicators(catalog, p).collect()},
        key=lambda r: [(v is not None, v) for v in r],
    )


def test_topics_of_the_same_terms_are_one_class(spark, rows, catalog):
    """What is found for a class is what is found for each of its topics, without a copy for each."""
    lists = [["ring"], ["ring"], ["Ring"], ["ring", "needle"], ["needle", "ring", "ring"], ["öre"], ["absent term"]]
    named = [(f"{i}{j}", x) for i, terms in enumerate(lists) for j in range(3) for x in terms] + [(None, "ring"), ("empty", None)]
    table = spark.createDataFrame(named, "topic string, term string")
    classes, members = topic_classes(table)
    assert rows(classes.select("topic").distinct()) == [("00",), ("20",), ("30",), ("50",), ("60",)]
    hits = select_by_topic_table(catalog, classes).withColumnRenamed("topic", "class")
    found = rows(hits.join(members, "class").select("topic", "IndicatorCode", "IndicatorName"))
    assert found == rows(select_by_topic_table(catalog, table)) and len(found) > 3 * hits.count() / 2


def test_postings_stay_where_their_names_are(spark, catalog, tmp_path):
    """A name's postings lie in one file, sorted by gram: they are made once and not shuffled."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_term_index(catalog, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    postings = spark.read.parquet(f"{tmp_path}/postings").withColumn("file", F.col("_metadata.file_path")).collect()
    files = {}
    for r in postings:
        files.setdefault(r["file"], []).append((r["gram"], r["id"]))
    assert len(files) > 1 and all([g for g, _ in x] == sorted(g for g, _ in x) for x in files.values())
    assert sum(len({i for _, i in x}) for x in files.values()) == len({r["id"] for r in postings})
