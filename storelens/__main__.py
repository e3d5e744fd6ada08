"""Command line: the two things the source project's users run.

  python -m storelens pipeline --apps APPS.csv --reviews REVIEWS.csv --out WAREHOUSE
      clean, land, stage and model both inputs; every model written under WAREHOUSE
  python -m storelens top-rated --warehouse WAREHOUSE [-n 5]
      the top-n best-rated apps (keyed fact ⋈ dim_apps)
  python -m storelens report --warehouse WAREHOUSE [--category GAME]
      one dashboard refresh: KPIs, top-rated apps, sentiment shares

The master and other settings come from spark-submit / the environment.
"""

from __future__ import annotations

import argparse
import sys

from storelens import plans
from storelens.sinks import read_current
from storelens.sources import read_apps_csv, read_reviews_csv


def _tables(spark, warehouse: str):
    def read(name):
        return read_current(spark, f"{warehouse.rstrip('/')}/{name}")
    return (read("fact_app_metrics_keyed"), read("dim_apps"), read("dim_categories"),
            None, read("review_counts"))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="storelens")
    sub = p.add_subparsers(dest="cmd", required=True)
    pp = sub.add_parser("pipeline")
    pp.add_argument("--apps", required=True)
    pp.add_argument("--reviews", required=True)
    pp.add_argument("--out", required=True)
    pp.add_argument("--multiline", action="store_true",
                    help="quoted fields may contain newlines")
    pt = sub.add_parser("top-rated")
    pt.add_argument("--warehouse", required=True)
    pt.add_argument("-n", type=int, default=5)
    pr = sub.add_parser("report")
    pr.add_argument("--warehouse", required=True)
    pr.add_argument("--category", default=None)
    args = p.parse_args(argv)

    from storelens.session import build_session
    spark = build_session()
    if args.cmd == "pipeline":
        report: dict[str, int] = {}
        plans.run_pipeline(read_apps_csv(spark, args.apps, args.multiline),
                           read_reviews_csv(spark, args.reviews, args.multiline),
                           args.out, report=report)
        print(f"landed {report['apps_landed']} apps and {report['reviews_landed']} reviews; "
              f"models written to {args.out}")
    elif args.cmd == "top-rated":
        keyed, dim_apps, *_ = _tables(spark, args.warehouse)
        plans.top_rated(keyed, dim_apps, args.n).show(args.n, truncate=False)
    else:
        v = plans.view(plans.DashboardInputs(*_tables(spark, args.warehouse))).cache()
        for name, df in plans.dashboard_panels(v, args.category).items():
            print(f"== {name}")
            df.show(max(1, df.count()), truncate=False)
        v.unpersist()
    return 0


if __name__ == "__main__":
    sys.exit(main())
