"""Print the final (post-AQE) physical plan of selected keys.

Usage: python tests/plan_report.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEYS = ["monthly_category_revenue", "category_daily_trend", "kpi_top_products", "amount_outliers",
        "region_vs_average", "dedup_latest", "kpi_revenue_by_region"]


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


if __name__ == "__main__":
    from shoplake.session import build_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or KEYS
    spark = build_session()
    for k in keys:
        df = E.queries()[k](spark, sf)
        df.collect()
        print(f"===== {k}")
        print(df._jdf.queryExecution().executedPlan().toString())
