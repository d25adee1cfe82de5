"""Command line of the jobs, for ``spark-submit`` or ``python -m shelfmark``.

    shelfmark run     --raw CSV --root DIR    all layers; fails on a bad run
    shelfmark bronze  --raw CSV --root DIR
    shelfmark silver  --root DIR
    shelfmark gold    --root DIR
    shelfmark inspect --root DIR --layer bronze|silver|gold
    shelfmark versions --root DIR             what is published, and where it lies
    shelfmark vacuum  --root DIR [--keep N] [--drafts]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfmark.plans.medallion import Layout, ingest, publish, refine
from shelfmark.plans.reports import bronze_report, gold_report, silver_report, version_report
from shelfmark.session import build_session
from shelfmark.sources.generations import vacuum
from shelfmark.storage import remove

JOBS = ["run", "bronze", "silver", "gold", "inspect", "versions", "vacuum"]
REPORTS = {"bronze": bronze_report, "silver": silver_report, "gold": gold_report}


def show(df: DataFrame) -> None:
    """All rows, brought to the driver one partition at a time."""
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join(map(str, row)))


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shelfmark")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--raw", help="CSV file, folder or glob")
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--layer", choices=list(REPORTS), help="layer to inspect")
    parser.add_argument("--origin", action="store_true", help="carry source file and ingestion time to silver")
    parser.add_argument("--dynamic", action="store_true", help="replace only the dates present")
    parser.add_argument("--rebalance", action="store_true", help="group raw files by date first")
    parser.add_argument("--check-header", action="store_true", help="fail on reordered columns")
    parser.add_argument("--check-counts", action="store_true", help="compare rows by date with the CSV")
    parser.add_argument("--keep", type=int, default=2, help="versions of a layer that stay readable")
    parser.add_argument("--drafts", action="store_true", help="vacuum what killed jobs left")
    arguments = parser.parse_args(argv)
    if arguments.job in ("run", "bronze") and not arguments.raw:
        parser.error(f"{arguments.job} needs --raw")
    if arguments.job == "inspect" and not arguments.layer:
        parser.error("inspect needs --layer")
    return arguments


def execute(spark: SparkSession, arguments: argparse.Namespace) -> None:
    job, layout = arguments.job, Layout(arguments.root, arguments.keep)
    if job in ("run", "bronze"):
        ingest(
            spark,
            arguments.raw,
            layout,
            dynamic=arguments.dynamic,
            rebalance=arguments.rebalance,
            check_header=arguments.check_header,
            check_counts=arguments.check_counts,
        )
    if job in ("run", "silver"):
        show(refine(spark, layout, origin=arguments.origin))
    if job in ("run", "gold"):
        show(publish(spark, layout))
    if job == "versions":
        show(version_report(spark, layout))
    if job == "vacuum":
        for name, home in layout.layers.items():
            gone = vacuum(spark, home, arguments.keep, arguments.drafts)
            for folder in gone if name == "silver" else ():
                remove(spark, f"{layout.silver_facts.data}/{folder}")
            print(f"{name}: {len(gone)} folders removed")
    if job == "inspect":
        for title, report in REPORTS[arguments.layer](spark, layout).items():
            print(f"-- {title}")
            show(report)


def main(argv: Sequence[str] | None = None) -> None:
    arguments = parse(argv)
    spark = build_session(f"shelfmark {arguments.job}")
    try:
        execute(spark, arguments)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
