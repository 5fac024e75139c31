"""The walk along next-page links against a plain one."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeframe.schemas import NEXT_LINK
from gaugeframe.sources.chain import BrokenChainError, chain_problems, pages_in_order, walk_pages


def plain_walk(links, starts=None):
    nodes = {}
    for url, to in links:
        if url is not None:
            nodes.setdefault(url, set()).update({to} - {None})
    follow = {u: min(t) if t else None for u, t in nodes.items()}
    referrers = {u: sum(u in t for t in nodes.values()) for u in nodes}
    first = [u for u in nodes if not referrers[u]] if starts is None else [u for u in starts if u in nodes]
    best = {}
    for start in first:
        url, number, seen = start, 0, set()
        while url in nodes and url not in seen:
            seen.add(url)
            best[url] = min(best.get(url, (number, start)), (number, start))
            url, number = follow[url], number + 1
    rows = set()
    for url in nodes:
        ahead, seen = follow[url], set()
        while ahead in nodes and ahead not in seen:
            seen.add(ahead)
            ahead = follow[ahead]
        number, start = best.get(url, (None, None))
        missing = follow[url] is not None and follow[url] not in nodes
        rows.add((url, number, start, referrers[url], len(nodes[url]), url in seen, missing))
    return rows


def random_links(seed):
    rng = random.Random(seed)
    names = [f"p{i:02}" for i in range(40)]
    links = [(n, rng.choice([*names, None, "lost"])) for n in names]
    links += [(f"c{i:03}", f"c{i + 1:03}") for i in range(100)] + [("c100", "c100" if seed else None)]
    links += [("p01", "p02"), ("p01", None), (None, "p03"), ("c050", "c051"), ("twice", "x1"), ("twice", "x2")]
    return links


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("starts", [None, ["p00", "c000", "nowhere"], ["c100"]])
def test_walk_equals_the_plain_one(spark, seed, starts):
    links = random_links(seed)
    pages = spark.createDataFrame(links, f"url string, `{NEXT_LINK}` string")
    assert {tuple(r) for r in walk_pages(pages, starts).collect()} == plain_walk(links, starts)


def test_starts_as_a_table_and_no_pages(spark):
    pages = spark.createDataFrame([("a", "b"), ("b", None)], f"url string, `{NEXT_LINK}` string")
    starts = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "url string")
    assert {tuple(r)[:3] for r in walk_pages(pages, starts).collect()} == {("a", 0, "a"), ("b", 1, "a")}
    assert walk_pages(pages.limit(0)).count() == 0


def landed(spark, links):
    pages = spark.createDataFrame(links, "url string, link string")
    link = F.when(F.col("link").isNotNull(), F.concat(F.lit(f', "{NEXT_LINK}": "'), "link", F.lit('"')))
    body = F.concat(F.lit('{"value": []'), F.coalesce(link, F.lit("")), F.lit("}"))
    return pages.select("url", F.lit(200).alias("status"), body.alias("body"), F.lit(7).alias("page_no"))


def test_pages_in_order(spark):
    pages = landed(spark, [("c", None), ("a", "b"), ("b", "c")])
    found = pages_in_order(pages).orderBy("page_no").select("url", "start", "page_no").collect()
    assert [tuple(r) for r in found] == [("a", "a", 0), ("b", "a", 1), ("c", "a", 2)]


@pytest.mark.parametrize(
    "links, problem",
    [
        ([("a", "b"), ("b", "a")], "unreachable"),
        ([("s", "a"), ("a", "b"), ("b", "a")], "on a cycle"),
        ([("a", "b")], "next page missing"),
        ([("a", "c"), ("b", "c"), ("c", None)], "several pages lead here"),
        ([("a", "b"), ("a", "c"), ("b", None), ("c", None)], "several next pages"),
    ],
)
def test_broken_chains_are_named(spark, links, problem):
    pages = landed(spark, links)
    with pytest.raises(BrokenChainError, match=problem):
        pages_in_order(pages)
    found = [r["url"] for r in pages_in_order(pages, strict=False).collect()]
    assert sorted(found) == {"unreachable": [], "several next pages": ["a", "a", "b"]}.get(problem, sorted(u for u, _ in links))


def test_few_rounds_for_a_long_chain(spark):
    pages = spark.range(3000).select(
        F.concat(F.lit("p"), F.col("id")).alias("url"), F.concat(F.lit("p"), F.col("id") + 1).alias(NEXT_LINK)
    )
    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("walk", "walk")
    walked = walk_pages(pages, ["p0"])
    assert walked.agg(F.max("page_no")).first()[0] == 2999
    jobs = len(tracker.getJobIdsForGroup("walk"))
    spark.sparkContext._jsc.sc().clearJobGroup()
    assert jobs < 400, jobs
    assert chain_problems(walked).collect()[0]["problem"] == "next page missing"
