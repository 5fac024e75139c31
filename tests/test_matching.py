import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeframe.functions.matching import matches_any, matching_topics, terms_pattern
from gaugeframe.plans.topics import TOPICS


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "IndicatorName string")


def hits(spark, values, terms, literal=False):
    flagged = names(spark, values).withColumn("hit", matches_any(F.col("IndicatorName"), terms, literal))
    return {r["IndicatorName"]: r["hit"] for r in flagged.collect()}


def test_case_is_ignored_and_terms_match_inside_words(spark):
    found = hits(spark, ["New HIV cases", "hiv", "Archive", "HI V", ""], ["HIV"])
    assert found == {"New HIV cases": True, "hiv": True, "Archive": True, "HI V": False, "": False}


def test_null_name_is_no_match(spark):
    found = hits(spark, [None, "malaria"], ["malaria", "plan(s)"])
    assert found == {None: False, "malaria": True}


def test_parentheses_are_groups_unless_literal(spark):
    values = ["Poisoning (unintentional) rate", "poisoning unintentional", "Dementia plans", "dementia plan(s)"]
    terms = ["Poisoning (unintentional)", "plan(s)"]
    assert hits(spark, values, terms) == dict(zip(values, [False, True, True, False]))
    assert hits(spark, values, terms, literal=True) == dict(zip(values, [True, False, False, True]))


def test_literal_terms_may_hold_quoting_marks(spark):
    values = [r"a\Eb", r"a\Qb é", "ab"]
    assert hits(spark, values, [r"\Eb"], literal=True) == {values[0]: True, values[1]: False, values[2]: False}
    assert hits(spark, values, [r"\Qb É"], literal=True) == {values[0]: False, values[1]: True, values[2]: False}


def test_letters_that_equal_ascii_letters_without_case(spark):
    values = ["ſuicide", "Kidney", "dıabetes", "DİABETES", "suicide"]
    for value, term in zip(values, ["suicide", "kidney", "diabetes", "diabetes", "SUICIDE"]):
        assert hits(spark, [value], [term]) == {value: True}
        assert re.search(term, value, re.IGNORECASE)


def test_accented_terms(spark):
    assert hits(spark, ["QUALITÉ", "qualite"], ["qualité"]) == {"QUALITÉ": True, "qualite": False}


@pytest.mark.parametrize("terms", [[], ["a", ""]])
def test_empty_terms_are_refused(terms):
    with pytest.raises(ValueError):
        terms_pattern(terms)


def test_topics_of_a_name(spark):
    patterns = {"a": ["red", "blue"], "b": ["blu(e|r)"], "c": ["green"]}
    df = names(spark, ["Blue", "RED", "none", None])
    found = df.select("IndicatorName", matching_topics(F.col("IndicatorName"), patterns).alias("t")).collect()
    assert {r[0]: r[1] for r in found} == {"Blue": ["a", "b"], "RED": ["a"], "none": [], None: []}


def test_substring_search_agrees_with_one_regular_expression(spark):
    """Built-in terms, in three letter cases and inside other text, against the plain alternation."""
    texts = []
    for topic in TOPICS:
        for term in topic.patterns:
            bare = re.sub(r"[()]", "", term)
            texts += [term.upper(), bare.lower(), f"x{bare}y", bare[1:], bare[:-1]]
    df = names(spark, sorted(set(texts)))
    for topic in TOPICS:
        plain = F.col("IndicatorName").rlike("(?iu)" + terms_pattern(topic.patterns))
        differ = df.filter(matches_any(F.col("IndicatorName"), topic.patterns) != plain)
        assert differ.count() == 0, topic.name


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.text("abAB(é.", min_size=1, max_size=3), min_size=1, max_size=4),
    st.lists(st.text("abABÉ(.é", max_size=8), min_size=1, max_size=12),
)
def test_literal_matching_agrees_with_python(spark, terms, values):
    found = hits(spark, values, terms, literal=True)
    pattern = "|".join(re.escape(t) for t in terms)
    assert found == {v: bool(re.search(pattern, v, re.IGNORECASE)) for v in values}
