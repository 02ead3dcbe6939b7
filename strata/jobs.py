"""Batch entry points for ``spark-submit``: bronze, silver, gold, updates and the monitoring report."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.lake import Lake
from strata.plans.bronze import ingest_all
from strata.plans.gold import build_products, integrate, integrate_changes, refresh_changes
from strata.plans.reports import monitoring_report
from strata.plans.runs import fold_runs
from strata.plans.silver import merge_dataset_update, promote_all
from strata.plans.updates import run_all_generators
from strata.streaming.ingest import ingest_stream


def run_bronze(spark: SparkSession, lake: Lake, datasets=None, mode: str = "auto") -> dict[str, int]:
    return ingest_all(spark, lake, datasets, mode=mode)


def run_silver(spark: SparkSession, lake: Lake, datasets=None) -> dict[str, tuple[int, int]]:
    return promote_all(spark, lake, datasets)


def run_gold(
    spark: SparkSession, lake: Lake, stage: str = "all", force_products: bool = False, borough_layout: bool = True
) -> dict[str, int]:
    if stage in ("integrate", "all"):
        integrate(spark, lake, write_borough_layout=borough_layout)
    return build_products(spark, lake, force=force_products) if stage in ("products", "all") else {}


def run_changes(spark: SparkSession, lake: Lake, borough_layout: bool = True) -> dict:
    """Bring gold up to date by what changed in silver: days of the integrated table, then partitions of the products."""
    return {"days": integrate_changes(spark, lake, write_borough_layout=borough_layout), **refresh_changes(spark, lake)}


def run_merge(spark: SparkSession, lake: Lake, datasets) -> dict[str, tuple[int, int]]:
    return {name: merge_dataset_update(spark, lake, name) for name in datasets}


def run_report(spark: SparkSession, lake: Lake, rows: int | None = None) -> None:
    """Print the monitoring reports, whole unless ``rows`` bounds them."""
    for name, report in monitoring_report(spark, lake).items():
        print(name)
        report.show(report.count() if rows is None else rows, truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strata")
    parser.add_argument("--lake", required=True, help="root of the lake")
    steps = parser.add_subparsers(dest="step", required=True)
    bronze = steps.add_parser("bronze")
    bronze.add_argument("--dataset", action="append", dest="datasets")
    bronze.add_argument("--mode", choices=("auto", "full", "incremental"), default="auto")
    silver = steps.add_parser("silver")
    silver.add_argument("--dataset", action="append", dest="datasets")
    gold = steps.add_parser("gold")
    gold.add_argument("--stage", choices=("integrate", "products", "all"), default="all")
    gold.add_argument("--force-products", action="store_true")
    gold.add_argument("--skip-borough-layout", action="store_true")
    gold.add_argument("--changes", action="store_true", help="rewrite only days and partitions whose input changed")
    steps.add_parser("updates")
    merge = steps.add_parser("merge", help="bring update files straight into silver")
    merge.add_argument("--dataset", action="append", dest="datasets", required=True)
    arrivals = steps.add_parser("stream", help="load the files that have arrived in a folder")
    arrivals.add_argument("--dataset", required=True)
    arrivals.add_argument("--source", required=True)
    fold = steps.add_parser("fold-log", help="fold the single rows of the run log into files")
    fold.add_argument("--most", type=int, default=200, help="directories of a layer that are left alone")
    report = steps.add_parser("report")
    report.add_argument("--rows", type=int, help="print at most so many rows of each report")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    # Hours and dates of timestamps are meant in UTC, whatever the zone of the cluster.
    builder = SparkSession.builder.appName(f"strata-{args.step}").config("spark.sql.session.timeZone", "UTC")
    spark = builder.getOrCreate()
    lake = Lake(args.lake)
    if args.step == "bronze":
        print(run_bronze(spark, lake, args.datasets, args.mode))
    elif args.step == "silver":
        print(run_silver(spark, lake, args.datasets))
    elif args.step == "gold" and args.changes:
        print(run_changes(spark, lake, not args.skip_borough_layout))
    elif args.step == "gold":
        print(run_gold(spark, lake, args.stage, args.force_products, not args.skip_borough_layout))
    elif args.step == "updates":
        for report in run_all_generators(spark, lake):
            print(report)
    elif args.step == "merge":
        print(run_merge(spark, lake, args.datasets))
    elif args.step == "stream":
        print(ingest_stream(spark, lake, args.dataset, args.source))
    elif args.step == "fold-log":
        print(fold_runs(spark, lake, args.most))
    else:
        run_report(spark, lake, args.rows)


if __name__ == "__main__":
    main()
