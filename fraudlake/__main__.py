"""Batch entry point: ``spark-submit -m fraudlake`` style runs.

    python -m fraudlake --source s3://.../landing/ --root s3://.../lake \
        [--database fraud] [--source-name card_feed] [--approx] [--min-rows 100000] [--on-fail raise]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from fraudlake.operators import quality
from fraudlake.plans import lakehouse


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fraudlake")
    ap.add_argument("--source", required=True, help="CSV file or folder of the transactions")
    ap.add_argument("--root", required=True, help="shared folder for all layer tables")
    ap.add_argument("--database", default=None, help="catalog database to register tables in")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--source-name", default=None, help="what Bronze records as the source "
                    "(default: --source)")
    ap.add_argument("--version", type=int, default=None, help="Silver version to (re)write")
    ap.add_argument("--approx", action="store_true",
                    help="percentile_approx thresholds instead of exact ones")
    ap.add_argument("--min-rows", type=int, default=100_000)
    ap.add_argument("--extra-checks", action="store_true")
    ap.add_argument("--max-age-hours", type=float, default=None, help="stale-data check")
    ap.add_argument("--on-fail", choices=("warn", "raise"), default="warn")
    args = ap.parse_args(argv)

    rules = quality.default_rules(min_rows=args.min_rows) + [quality.malformed_rule()]
    if args.extra_checks:
        rules += quality.extra_rules()
    if args.max_age_hours is not None:
        rules.append(quality.freshness_rule(args.max_age_hours))
    spark = SparkSession.builder.appName("fraudlake").getOrCreate()
    res = lakehouse.run(spark, args.source, args.root, database=args.database,
                        run_id=args.run_id, version=args.version, exact=not args.approx,
                        rules=rules, on_fail=args.on_fail,
                        source_name=args.source_name or args.source)
    print(json.dumps({"run_id": res.run_id, "version": res.version,
                      "checks": [r.asDict() for r in res.report]}, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
