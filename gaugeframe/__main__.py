"""Export topics from landed pages: ``spark-submit`` this module or ``python -m gaugeframe``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gaugeframe.plans.export import export_with_report
from gaugeframe.plans.topics import TOPICS, pages_for_topics, stopped_at_failures, topic_named
from gaugeframe.sources.accounting import AccountedScan
from gaugeframe.sources.landing import ensure_complete, read_landed, scan_catalog
from gaugeframe.storage import cut_lineage


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gaugeframe")
    parser.add_argument("--catalog", required=True, help="landed catalogue pages")
    parser.add_argument("--observations", required=True, help="landed observation pages")
    parser.add_argument("--output", required=True, help="folder for the CSV files")
    parser.add_argument("--topic", action="append", default=[], help="topic name; all topics if left out")
    parser.add_argument("--format", default="json", choices=["json", "parquet"], help="format of the landing tables")
    parser.add_argument(
        "--on-error",
        choices=["skip", "fail"],
        help="failed responses of selected indicators; if left out, as each topic asks for",
    )
    parser.add_argument("--catalog-on-error", choices=["skip", "fail"], default="fail", help="failed catalogue pages")
    parser.add_argument("--allow-missing-pages", action="store_true", help="linked pages may be absent")
    parser.add_argument(
        "--on-missing", choices=["none", "fail"], help="pages without rows; if left out, as each topic asks for"
    )
    parser.add_argument(
        "--max-bad-share",
        type=float,
        help="leave out what cannot be read and publish nothing if that is more than this share; if left out, stop at it",
    )
    parser.add_argument("--report", help="folder for counts per topic and codes without data")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("gaugeframe").getOrCreate()
    topics = [topic_named(name) for name in args.topic] or TOPICS
    catalog_pages = read_landed(spark, args.catalog, args.format)
    if not args.allow_missing_pages:
        ensure_complete(catalog_pages, args.catalog_on_error)
    catalog = scan_catalog(catalog_pages, args.catalog_on_error, on_missing=args.on_missing or "none")
    catalog = cut_lineage(catalog)
    landed = read_landed(spark, args.observations, args.format)
    pages = pages_for_topics(catalog, landed, topics, args.on_error, args.on_missing)
    if not args.allow_missing_pages:
        ensure_complete(pages)
    lenient = args.max_bad_share is not None
    scan = AccountedScan(stopped_at_failures(pages), F.col("strict_rows"), "mark" if lenient else "fail")
    check = (lambda: scan.check(args.max_bad_share)) if lenient else None
    report = export_with_report(catalog, scan.rows, args.output, topics, report_path=args.report, check=check)
    lacking = report.without_rows
    print(f"exported {len(topics) - len(lacking)} topics to {args.output}; without data: {lacking}; {scan.counts}")


if __name__ == "__main__":
    main()
