"""Load feeds once: ``python -m sheetmill --sheets ... --job-id ... --date 20240105 ...``.

Feeds are taken from a folder of YAML configurations, or from the exported control sheet,
where only jobs with status OK run.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from sheetmill.model import load_configs
from sheetmill.operators.control import approved_configs, read_control
from sheetmill.operators.validate import run_context
from sheetmill.plans.load import load_feeds
from sheetmill.rules import RuleSet
from sheetmill.session import SETTINGS
from sheetmill.sources.tables import Warehouse


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sheetmill", description=__doc__)
    parser.add_argument("--sheets", required=True, help="folder with one folder of exports per job")
    parser.add_argument("--job-id", required=True, help="identity of this run")
    parser.add_argument("--date", required=True, help="run date, yyyymmdd")
    parser.add_argument("--warehouse", help="base folder of the tables; default: the catalog")
    origin = parser.add_mutually_exclusive_group(required=True)
    origin.add_argument("--configs", help="folder of YAML configurations")
    origin.add_argument("--control", help="folder that holds the exported control sheet")
    parser.add_argument("--job", action="append", dest="jobs", help="load only this job (repeatable)")
    parser.add_argument("--rules", choices=("reference", "aligned"), default="reference")
    parser.add_argument("--sample-limit", type=int, help="infer types from at most this many rows")
    parser.add_argument("--idempotent", action="store_true", help="replace rejects of the same run")
    parser.add_argument("--parallel", type=int, default=4, help="kinds of feeds loaded at the same time")
    parser.add_argument("--resume", action="store_true", help="go on after the layers that this run has finished")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("sheetmill").config(map=SETTINGS).getOrCreate()
    if args.control:
        configs = approved_configs(read_control(spark, args.control), args.jobs)
    else:
        configs = [c for c in load_configs(args.configs) if not args.jobs or c.job_name in args.jobs]
    results = load_feeds(
        spark,
        args.sheets,
        configs,
        run_context(spark, args.job_id, args.date),
        Warehouse(spark, args.warehouse),
        getattr(RuleSet, args.rules)(),
        sample_limit=args.sample_limit,
        idempotent=args.idempotent,
        parallel=args.parallel,
        resume=args.resume,
    )
    for job, result in results.items():
        if result.error:
            print(f"{job}: failed: {result.error}", file=sys.stderr)
        else:
            groups = f"date={list(result.schema.date)} numeric={list(result.schema.numeric)}"
            counts = " ".join(f"{layer}={n}" for layer, n in result.counts.items())
            print(f"{job}: loaded, {groups} {counts}")
    return 1 if any(r.error for r in results.values()) else 0


if __name__ == "__main__":
    sys.exit(main())
