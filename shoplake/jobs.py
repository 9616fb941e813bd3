"""spark-submit entry point: ``spark-submit shoplake/jobs.py <job> [options]``.

Jobs: bronze-to-silver, silver-to-gold, quality-check, pipeline, report.
The session comes from spark-submit (cluster settings); the lake settings
are applied on top. Paths may be any Hadoop file system URI.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shoplake.functions.timeparse import hours_before  # noqa: E402
from shoplake.operators import cleaning, quality, reports  # noqa: E402
from shoplake.plans.lake import Lake  # noqa: E402
from shoplake.plans.pipeline import run_pipeline  # noqa: E402
from shoplake.schemas import CORRUPT_COL  # noqa: E402
from shoplake.session import apply_lake_conf  # noqa: E402
from shoplake.sinks.writers import write_results  # noqa: E402
from shoplake.sources.zones import read_bronze  # noqa: E402
from shoplake.streaming import incremental  # noqa: E402

REPORTS = {
    # name: (zone, function, parameters after the DataFrame)
    "monthly_category_revenue": ("gold:revenue_by_product", reports.monthly_category_revenue, ["year", "month"]),
    "category_daily_trend": ("gold:revenue_by_product", reports.category_daily_trend, ["year", "month", "category"]),
    "category_revenue_share": ("gold:revenue_by_product", reports.category_revenue_share, ["year", "month", "day"]),
    "mom_growth": ("gold:revenue_by_product", reports.mom_growth, ["year", "month", "prev_year", "prev_month"]),
    "monthly_region_performance": ("gold:revenue_by_region", reports.monthly_region_performance, ["year", "month"]),
    "region_daily_trend": ("gold:revenue_by_region", reports.region_daily_trend, ["year", "month"]),
    "best_region_per_day": ("gold:revenue_by_region", reports.best_region_per_day, ["year", "month"]),
    "region_vs_average": ("gold:revenue_by_region", reports.region_vs_average, ["year", "month"]),
    "amount_outliers": ("silver", reports.amount_outliers, ["year", "month"]),
    "store_volume_drop": ("silver", reports.store_volume_drop, ["year", "month"]),
    "return_rate_spikes": ("silver", reports.return_rate_spikes, ["year", "month"]),
    "hourly_volume": ("silver", reports.hourly_volume, ["year", "month", "day"]),
    "month_transaction_count": ("silver", reports.month_transaction_count, ["year", "month"]),
    "customer_patterns": ("silver", reports.customer_patterns, []),
    "transaction_trend": ("silver", reports.transaction_trend, []),
}


def _days(spec: str | None):
    if not spec:
        return None
    return [tuple(d.split("-")) for d in spec.split(",")]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shoplake")
    sub = ap.add_subparsers(dest="job", required=True)
    b2s = sub.add_parser("bronze-to-silver")
    b2s.add_argument("--bronze", required=True)
    b2s.add_argument("--lake", required=True)
    b2s.add_argument("--checkpoint", help="incremental (exactly-once) when given")
    b2s.add_argument("--files-per-batch", type=int)
    s2g = sub.add_parser("silver-to-gold")
    s2g.add_argument("--lake", required=True)
    s2g.add_argument("--days", help="yyyy-mm-dd,... (default: every day)")
    qc = sub.add_parser("quality-check")
    qc.add_argument("--bronze", required=True)
    qc.add_argument("--threshold", type=float, default=quality.QUALITY_THRESHOLD)
    pl = sub.add_parser("pipeline")
    pl.add_argument("--bronze", required=True)
    pl.add_argument("--lake", required=True)
    since = pl.add_mutually_exclusive_group(required=True)
    since.add_argument("--modified-after", help="yyyy-MM-ddTHH:mm:ss (UTC)")
    since.add_argument("--as-of", help="yyyy-MM-ddTHH:mm:ss (UTC): files of the 25 hours before it")
    pl.add_argument("--month", required=True, help="yyyy-mm for the persisted reports")
    pl.add_argument("--run-id", default="run")
    rp = sub.add_parser("report")
    rp.add_argument("name", choices=sorted(REPORTS))
    rp.add_argument("--lake", required=True)
    for p in ("year", "month", "day", "category", "prev_year", "prev_month"):
        rp.add_argument(f"--{p.replace('_', '-')}", dest=p)
    rp.add_argument("--out", help="write results here (run id = --run-id)")
    rp.add_argument("--run-id", default="run")
    args = ap.parse_args(argv)
    if args.job == "report":
        lacking = [f"--{p.replace('_', '-')}" for p in REPORTS[args.name][2] if getattr(args, p) is None]
        if lacking:
            ap.error(f"report {args.name} needs {', '.join(lacking)}")

    spark = SparkSession.builder.appName(f"shoplake-{args.job}").getOrCreate()
    apply_lake_conf(spark)

    if args.job == "bronze-to-silver":
        lake = Lake(spark, args.lake)
        if args.checkpoint:
            incremental.run_incremental(spark, args.bronze, lake, args.checkpoint, args.files_per_batch)
        else:
            bronze = read_bronze(spark, args.bronze, keep_corrupt=True)
            lake.write_errors(bronze, "source=full/batch=0")
            lake.build_silver(cleaning.type_transactions(bronze.filter(F.col(CORRUPT_COL).isNull())))
    elif args.job == "silver-to-gold":
        lake = Lake(spark, args.lake)
        days = _days(args.days)
        if days:
            incremental.rebuild_gold(spark, lake, days)
        else:
            lake.build_gold()
    elif args.job == "quality-check":
        checked = quality.validate(read_bronze(spark, args.bronze, keep_corrupt=True))  # a broken line is an invalid record
        v = quality.gate(quality.score(checked), args.threshold).first()
        print(json.dumps(v.asDict()))
        return 0 if v.status == quality.STATUS_OK else 2
    elif args.job == "pipeline":
        year, month = args.month.split("-")
        r = run_pipeline(spark, args.bronze, Lake(spark, args.lake), args.modified_after or hours_before(args.as_of), (year, month),
                         run_id=args.run_id)
        print(json.dumps({"status": r.status, "quality_score": r.quality_score, "records": r.records,
                          "results": r.results, "older": r.older}))
        return 0 if r.status == quality.STATUS_OK else 2
    elif args.job == "report":
        zone, fn, params = REPORTS[args.name]
        lake = Lake(spark, args.lake)
        df = lake.silver() if zone == "silver" else lake.gold(zone.split(":", 1)[1])
        out = fn(df, *[getattr(args, p) for p in params])
        path = write_results(out, args.out or f"{args.lake.rstrip('/')}/report_results", args.name, args.run_id)
        print(json.dumps({"path": path, "rows": spark.read.parquet(path).count()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
