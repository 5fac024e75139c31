"""Following next-page links: the number of every page, and what breaks a chain.

A chain is walked for all pages at once by pointer doubling: a table of jumps says which page
is 1, 2, 4, ... pages ahead, and every round joins it with itself and with the pages reached
so far, so a chain of n pages takes about log2(n) rounds instead of n.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.operators.joins import join_on_key
from gaugeframe.schemas import NEXT_LINK
from gaugeframe.sources.landing import OnError, page_links
from gaugeframe.storage import cut_lineage


class BrokenChainError(RuntimeError):
    """The pages do not form whole chains from their start pages."""


def walk_pages(pages: DataFrame, starts: Iterable[str] | DataFrame | None = None, link: str = NEXT_LINK) -> DataFrame:
    """Every address of ``pages`` (``url`` and its link) with its place in the chain.

    ``page_no`` counts from 0 at the start page ``start``; of several ways to a page the shortest
    counts, then the least start page; both are null for an unreachable page.  Start pages
    are given by address (a list, or a column ``url``), or are the pages that no page links to.
    ``referrers`` counts the pages that link here, ``links`` the different links of the
    address, of which the least is followed; ``on_cycle`` marks pages that lead back to
    themselves, ``next_missing`` those whose next page is not there.  Pages without an
    address are left out; a table without pages gives no rows.
    """
    named = pages.select("url", F.col(f"`{link}`").alias("to")).filter("url is not null").distinct()
    # One row per address, read in every round.
    nodes = cut_lineage(named.groupBy("url").agg(F.min("to").alias("to"), F.count("to").alias("links")))
    referrers = named.filter("to is not null").groupBy(F.col("to").alias("url")).agg(F.count("*").alias("referrers"))
    known = nodes.select(F.col("url").alias("to"))
    edges = cut_lineage(join_on_key(nodes.filter("to is not null").select("to", "url"), known, "to", "left_semi"))
    counted = cut_lineage(nodes.join(referrers, "url", "left").fillna(0, ["referrers"]))
    if starts is None:
        first = counted.filter("referrers = 0").select("url")
    elif isinstance(starts, DataFrame):
        first = starts.select("url").distinct().join(nodes, "url", "left_semi")
    else:
        first = nodes.select("url").filter(F.col("url").isin(list(starts)))
    reached, cyclic = _doubled(edges, cut_lineage(first))
    linked = edges.select("url", F.lit(False).alias("no_next"))
    found = counted.join(reached, "url", "left").join(linked, "url", "left").join(cyclic, "url", "left")
    return found.select(
        "url",
        F.col("place.page_no").alias("page_no"),
        F.col("place.start").alias("start"),
        "referrers",
        "links",
        F.coalesce("cyclic", F.lit(False)).alias("on_cycle"),
        (F.col("to").isNotNull() & F.coalesce("no_next", F.lit(True))).alias("next_missing"),
    )


def _doubled(edges: DataFrame, first: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of the pages that can be reached, and the pages on cycles.

    After a round that reaches no new page there are none further on.  The pages that jumps
    lead to become fewer from round to round; once they stay the same, every jump among them can
    be turned back, so they are the pages on cycles.
    """
    place = F.struct(F.lit(0).cast("long").alias("page_no"), F.col("url").alias("start"))
    reached = first.select("url", place.alias("place"))
    jumps, ahead = edges, 1
    held, targets, walking = reached.count(), None, True
    while True:
        count = jumps.select("to").distinct().count()
        settled = count == targets or not count
        targets = count
        if walking and count:
            moved = join_on_key(reached, jumps, "url").select(
                F.col("to").alias("url"),
                F.struct((F.col("place.page_no") + ahead).alias("page_no"), F.col("place.start").alias("start")).alias("place"),
            )
            reached = cut_lineage(reached.union(moved).groupBy("url").agg(F.min("place").alias("place")))
            before, held = held, reached.count()
            walking = held > before
        if settled and not (walking and count):
            break
        onward = jumps.select(F.col("url").alias("to"), F.col("to").alias("onward"))
        jumps = cut_lineage(join_on_key(jumps, onward, "to").select(F.col("onward").alias("to"), "url"))
        ahead *= 2
    cyclic = jumps.select(F.col("to").alias("url")).distinct().withColumn("cyclic", F.lit(True))
    return reached, cyclic


def chain_problems(walked: DataFrame) -> DataFrame:
    """Address and problem of the pages at which chains break, one row for each problem."""
    problems = {
        "unreachable": F.col("page_no").isNull(),
        "on a cycle": F.col("on_cycle"),
        "next page missing": F.col("next_missing"),
        "several pages lead here": F.col("referrers") > 1,
        "several next pages": F.col("links") > 1,
    }
    named = F.array_compact(F.array(*[F.when(test, name) for name, test in problems.items()]))
    return walked.select("url", F.explode(named).alias("problem"))


def pages_in_order(
    landed: DataFrame, starts: Iterable[str] | DataFrame | None = None, on_error: OnError = "skip", strict: bool = True
) -> DataFrame:
    """The landed pages that the chains reach, with ``start`` and ``page_no``.

    ``strict`` raises ``BrokenChainError`` and names some of the pages at which chains break;
    otherwise pages that no chain reaches are left out.
    """
    walked = cut_lineage(walk_pages(page_links(landed, on_error), starts))
    if strict:
        broken = [f"{r['url']} ({r['problem']})" for r in chain_problems(walked).limit(5).collect()]
        if broken:
            raise BrokenChainError(f"broken page chains, among others at {broken}")
    places = walked.filter("page_no is not null").select("url", "start", "page_no")
    kept = landed.drop("start", "page_no")
    return join_on_key(kept, places, "url")
