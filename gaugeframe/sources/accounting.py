"""What a job has read, skipped and dropped, counted in the pass that does the work."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gaugeframe.functions.numbers import input_error
from gaugeframe.schemas import OBSERVATION, PROBLEM
from gaugeframe.sources.landing import OnMissing, OnUnreadable, decode_pages, stamp_code, unnest_rows


class BadShareError(RuntimeError):
    """More of the input cannot be read than the job allows."""


@dataclass(frozen=True)
class PageCounts:
    """Pages and rows of one run.  Failed pages have another status than 200; pages without rows are
    readable, as error bodies are; unreadable ones are no pages; bad rows have a value that is no number."""

    pages: int
    failed: int
    without_rows: int
    unreadable: int
    rows: int
    bad_rows: int

    @property
    def bad_share(self) -> float:
        """Share of the pages that failed, have no rows or cannot be read, or of bad rows if that is more."""
        of_pages = (self.failed + self.without_rows + self.unreadable) / self.pages if self.pages else 0.0
        read = self.rows + self.bad_rows
        return max(of_pages, self.bad_rows / read if read else 0.0)


class AccountedScan:
    """The observations of landed pages, and the counts of the first job that reads them all.

    Failed pages are left out, pages without rows too unless ``on_missing`` stops at them.  What cannot be
    read stops the job, or with ``mark`` is left out as well.  All of it is counted.  ``rows`` is lazy;
    ``counts`` are those of the first job over ``rows``, and wait for it.
    """

    def __init__(
        self, landed: DataFrame, on_missing: OnMissing | Column = "none", on_unreadable: OnUnreadable = "fail"
    ) -> None:
        self._pages, self._rows = Observation(), Observation()
        good = F.coalesce(F.col("status") == 200, F.lit(False))
        # A failed page goes on without its body, so that it is counted with the others.
        kept = landed.withColumn("failed", ~good).withColumn("body", F.when(good, F.col("body")))
        kept = kept.withColumn("status", F.lit(200))
        decoded = decode_pages(kept, OBSERVATION, on_unreadable="mark", on_missing="fail")
        problem = F.when(F.col("failed"), "failed").otherwise(F.col(PROBLEM))
        decoded = decoded.withColumn(PROBLEM, problem)
        counted = decoded.observe(
            self._pages,
            F.count("*").alias("pages"),
            *[F.count_if(F.coalesce(F.col(PROBLEM) == p, F.lit(False))).alias(name) for name, p in _PAGE_PROBLEMS.items()],
        )
        strict = on_missing if isinstance(on_missing, Column) else F.lit(on_missing == "fail")
        stops = ((F.col(PROBLEM) == "no rows") & strict) | ((F.col(PROBLEM) == "not a page") & F.lit(on_unreadable == "fail"))
        address = [F.coalesce(F.col(c), F.lit("")) for c in ("url", "code") if c in landed.columns]
        stop = input_error("unreadable page (", F.col(PROBLEM), "): ", F.concat_ws(" ", *address))
        sound = counted.filter(F.when(stops, stop.cast("boolean")).otherwise(F.col(PROBLEM).isNull()))
        rows = stamp_code(unnest_rows(sound, keep=("code",)), "code")
        bad = F.col(PROBLEM).isNotNull()
        counted = rows.observe(self._rows, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("bad_rows"))
        if on_unreadable == "fail":
            bad = F.when(bad, input_error(F.col(PROBLEM)).cast("boolean")).otherwise(False)
        self.rows = counted.filter(~bad).drop(PROBLEM)

    @property
    def counts(self) -> PageCounts:
        return PageCounts(**self._pages.get, **self._rows.get)

    def check(self, most_bad: float) -> PageCounts:
        """The counts, or an error if the bad share is above ``most_bad``."""
        counts = self.counts
        if counts.bad_share > most_bad:
            raise BadShareError(f"{counts.bad_share:.2%} of the input cannot be used, allowed are {most_bad:.2%}: {counts}")
        return counts


_PAGE_PROBLEMS = {"failed": "failed", "without_rows": "no rows", "unreadable": "not a page"}
