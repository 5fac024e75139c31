"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores.
Every query is built, planned and run to its last row; nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

from gaugeframe.__main__ import main
from gaugeframe.operators.facts import observations_for, union_all
from gaugeframe.operators.reshape import clean_long, prune
from gaugeframe.operators.selection import select_indicators
from gaugeframe.session import local_session
from gaugeframe.storage import scratch_path
from workload import tables
from workload.queries import QUERIES

HEADLINE = (
    "catalog_scan",
    "page_rows",
    "page_chain_audit",
    "any_term",
    "any_term_documents",
    "observation_scan",
    "selected_observations",
    "selected_observations_shuffled",
    "indicators_lacking_data",
    "numbered_indicators",
    "grouped_mean",
    "grouped_mean_many",
    "wide_known_keys",
    "wide_discovered_keys",
    "wide_many_entities",
    "long_by_keys",
    "long_csv",
    "wide_csv",
    "topic_long",
    "topic_wide_table",
    "all_topics_selection",
    "all_topics_documents",
    "all_topics_rows",
    "topics_one_by_one",
    "all_topics_means",
    "all_topics_means_shuffled",
    "exported_topics",
    "landed_pages_to_csv",
    "pages_inferred",
    "indexed_terms",
    "topics_as_table",
    "clustered_observations",
    "selected_pages",
    "grouped_mean_exact",
)


def topics_one_by_one(spark, folder: str):
    """The result of ``all_topics_rows`` with one scan per topic, for comparison."""
    rows = tables.observations(spark, folder, all_years=True)
    parts = tables.catalog(spark, folder)
    chosen = [observations_for(prune(rows), select_indicators(parts, t.patterns)) for t in tables.PART_TOPICS]
    longs = [clean_long(c, "ENTITY", t.null_policy) for c, t in zip(chosen, tables.PART_TOPICS)]
    return union_all([x.withColumn("topic", F.lit(t.name)) for x, t in zip(longs, tables.PART_TOPICS)])


def landed_pages_to_csv(spark, folder: str):
    """The command line job over the given tables as landed pages: built-in topics to files."""
    root = scratch_path(spark, "bench")
    names = tables.topical_catalog(spark, folder)
    entry = F.to_json(F.struct(F.array(F.struct("IndicatorCode", "IndicatorName")).alias("value")))
    page = [F.lit(200).alias("status"), entry.alias("body")]
    names.select(F.col("IndicatorCode").alias("url"), F.lit(None).cast("string").alias("code"), *page).write.parquet(f"{root}/catalog")
    rows = tables.landed_observations(spark, folder).withColumn("code", F.regexp_extract("url", "[0-9]+", 0))
    rows.write.parquet(f"{root}/facts")
    main(["--catalog", f"{root}/catalog", "--observations", f"{root}/facts", "--output", f"{root}/out", "--format", "parquet"])
    return spark.range(1)


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    query = OWN.get(name) or QUERIES[name]
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


OWN = {"topics_one_by_one": topics_one_by_one, "landed_pages_to_csv": landed_pages_to_csv}


def bench() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "gaugeframe-bench")
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("any_term", "grouped_mean"):  # start-up and code compilation
        seconds(spark, folder, name)
    times = {name: round(seconds(spark, folder, name), 3) for name in sys.argv[1:] or HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    bench()
